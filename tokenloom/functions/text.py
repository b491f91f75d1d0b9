"""Column expressions for text: newline folding, special-token cutting,
pretokenizing, and the bracketed-hex symbol form used by the merge loop.

All of these are built-in JVM expressions (whole-stage codegen); no UDFs.
"""

from __future__ import annotations

import regex

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical output)
#
# Pretoken pattern (GPT-2 style), applied with Unicode character classes:
#   '(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# Default special token: <|endoftext|>
# ---------------------------------------------------------------------------
PRETOKEN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = "<|endoftext|>"

# Java regex: (?U) makes \s Unicode white space (NBSP, U+2003, U+0085 ...).
JAVA_PRETOKEN_PATTERN = "(?U)" + PRETOKEN_PATTERN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_newlines(text: str | Column) -> Column:
    """CRLF and lone CR become LF."""
    return F.regexp_replace(_col(text), F.lit("\r\n?"), F.lit("\n"))


def specials_longest_first(specials: list[str]) -> list[str]:
    """Order specials by the length of their escaped form, longest first
    (stable for equal lengths), so an overlapping longer token wins."""
    return sorted(specials, key=lambda s: len(regex.escape(s)), reverse=True)


def special_alternation(specials: list[str]) -> str:
    """A Java regex alternation matching any special token literally."""
    return "|".join(regex.escape(s) for s in specials_longest_first(specials))


def split_special_drop(text: str | Column, specials: list[str]) -> Column:
    """Cut at specials and drop them (training side).  Returns array<string>.

    An empty list means no cutting at all."""
    if not specials:
        return F.array(_col(text))
    return F.split(_col(text), special_alternation(specials), -1)


def split_special_keep(text: str | Column, specials: list[str]) -> Column:
    """Cut at specials, keeping each special as its own part and dropping
    empty parts (encoding side).  Returns array<string>."""
    if not specials:
        return F.when(F.length(_col(text)) > 0, F.array(_col(text))).otherwise(
            F.array().cast("array<string>")
        )
    alt = special_alternation(specials)
    pattern = f"(?s)(?:{alt})|.+?(?=(?:{alt})|\\z)"
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))


def pretokenize(text: str | Column) -> Column:
    """Text -> ordered pretoken pieces, array<string>."""
    return F.regexp_extract_all(_col(text), F.lit(JAVA_PRETOKEN_PATTERN), F.lit(0))


def hex_symbols(piece: str | Column) -> Column:
    """Piece -> one bracketed upper-case hex symbol per UTF-8 byte: `<74><68>`.

    Hex order equals unsigned byte order, and brackets keep a textual
    `replace` from matching across symbol edges."""
    return F.regexp_replace(F.hex(F.encode(_col(piece), "UTF-8")), F.lit("(..)"), F.lit("<$1>"))


def symbol_array(sym: str | Column) -> Column:
    """`<74><6865>` -> ['74', '6865']."""
    s = _col(sym)
    return F.split(F.substring(s, F.lit(2), F.length(s) - 2), "><")


def bracket(hex_col: Column) -> Column:
    return F.concat(F.lit("<"), hex_col, F.lit(">"))
