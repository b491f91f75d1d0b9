"""DuckDB SQL that recomputes registered queries from the raw tables.

DuckDB's RE2 has no look-ahead and an ASCII `\\s`, so the pretoken rule is
rewritten: a whitespace run followed by a non-space gets a U+0001 marker before
its last character (that character then starts the next piece, which is what
`\\s+(?!\\S)` does), and whitespace is the explicit class W below.  The merge
loop is unrolled: one materialized CTE per merge.
"""

from __future__ import annotations

SPECIAL = "<|endoftext|>"
SPECIAL_RE = r"<\|endoftext\|>"

W = r"[\s\x0b\x{85}\p{Z}]"
NOT_W = r"[^\s\x0b\x{85}\p{Z}]"
PIECE_RE = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\x0b\x{85}\p{Z}\p{L}\p{N}\x01]+|"
    + W
    + "+"
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def pretoken_list(text_sql: str) -> str:
    """SQL list of pretoken pieces of an expression."""
    marked = f"regexp_replace({text_sql}, {q('(' + W + ')(' + W + NOT_W + ')')}, '\\1' || chr(1) || '\\2', 'g')"
    return f"regexp_extract_all({marked}, {q(PIECE_RE)})"


def hex_sym(piece_sql: str) -> str:
    return f"regexp_replace(hex(encode({piece_sql})), '(..)', '<\\1>', 'g')"


def training_pieces_cte(table: str = "documents") -> str:
    """CTEs `tp_parts` and `tp_pieces(doc_id, part, pos, piece)`."""
    norm = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"
    return f"""
tp_parts AS (
  SELECT doc_id, unnest(generate_series(0, len(string_split({norm}, {q(SPECIAL)})) - 1)) AS part,
         unnest(string_split({norm}, {q(SPECIAL)})) AS chunk
  FROM {table}
),
tp_lists AS (SELECT doc_id, part, {pretoken_list('chunk')} AS ps FROM tp_parts),
tp_pieces AS (
  SELECT doc_id, part, unnest(generate_series(0, len(ps) - 1)) AS pos, unnest(ps) AS piece
  FROM tp_lists
)"""


def freqs_cte() -> str:
    return training_pieces_cte() + """,
freqs AS (SELECT piece, count(*) AS n FROM tp_pieces GROUP BY piece)"""


def pairs_sql(words: str) -> str:
    return f"""SELECT l, r, CAST(sum(n) AS BIGINT) AS c FROM (
    SELECT syms[j] AS l, syms[j + 1] AS r, n FROM (
      SELECT syms, n, unnest(generate_series(1, len(syms) - 1)) AS j FROM (
        SELECT string_split(substr(sym, 2, length(sym) - 2), '><') AS syms, n FROM {words}
        WHERE instr(sym, '><') > 0)))
  GROUP BY l, r HAVING sum(n) > 0"""


def train_ctes(num_merges: int, more: str = "") -> str:
    """CTEs ending in `merges(rank, l, r, c)` (hex symbols) and `w{n}(piece,
    sym, n)`, every training piece as its symbols.  `more`: SQL of further
    pieces, carried along with the weight 0, so that they count for nothing
    and end up encoded: each merge is applied to all words in rank order."""
    words = "SELECT piece, n FROM freqs"
    if more:
        words += f" UNION ALL SELECT DISTINCT piece, 0 FROM ({more}) WHERE piece NOT IN (SELECT piece FROM freqs)"
    parts = [freqs_cte() + f""",
w0 AS MATERIALIZED (SELECT piece, {hex_sym('piece')} AS sym, n FROM ({words}))"""]
    for i in range(1, num_merges + 1):
        parts.append(f"""
m{i} AS MATERIALIZED (
  SELECT CAST({i - 1} AS BIGINT) AS rank, l, r, c FROM ({pairs_sql(f'w{i - 1}')})
  ORDER BY c DESC, l DESC, r DESC LIMIT 1
),
w{i} AS MATERIALIZED (
  SELECT piece, replace(sym, '<' || m.l || '><' || m.r || '>', '<' || m.l || m.r || '>') AS sym, n
  FROM w{i - 1}, m{i} AS m
)""")
    union = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(1, num_merges + 1))
    if num_merges:
        parts.append(f"""
merges AS ({union})""")
    return ",".join(parts)


def vocab_cte(num_specials: int = 1) -> str:
    """`vocab(token_id, token_hex, is_special)` from `merges`."""
    k = num_specials
    return f"""
vocab AS (
  SELECT CAST(0 AS BIGINT) AS token_id, hex(encode({q(SPECIAL)})) AS token_hex, true AS is_special
  UNION ALL
  SELECT CAST({k} + b AS BIGINT), upper(lpad(to_hex(b), 2, '0')), false FROM range(256) t(b)
  UNION ALL
  SELECT CAST({256 + k} + rank AS BIGINT), l || r, false FROM merges
)"""


def encode_ctes(num_merges: int) -> str:
    """After `train_ctes`: `enc_piece_ids(piece, k, token_id)` for every piece
    that went through the merges (applying them in rank order equals
    lowest-rank-first when no two merges give the same bytes)."""
    return f"""
sym_id AS (
  SELECT token_hex, max(token_id) AS token_id FROM vocab WHERE NOT is_special GROUP BY token_hex
),
enc_words AS (
  SELECT piece, string_split(substr(sym, 2, length(sym) - 2), '><') AS syms FROM w{num_merges}
),
enc_symbols AS (
  SELECT piece, unnest(generate_series(0, len(syms) - 1)) AS k, unnest(syms) AS token_hex FROM enc_words
),
enc_piece_ids AS MATERIALIZED (
  SELECT e.piece, e.k, s.token_id FROM enc_symbols e JOIN sym_id s USING (token_hex)
)"""


def encode_pieces_cte(table: str = "documents") -> str:
    """`ep_pieces(doc_id, pos, piece)`: pieces of each whole text as is."""
    return f"""
ep_lists AS (SELECT doc_id, {pretoken_list('text')} AS ps FROM {table}),
ep_pieces AS (
  SELECT doc_id, unnest(generate_series(0, len(ps) - 1)) AS pos, unnest(ps) AS piece FROM ep_lists
)"""


def doc_tokens_cte() -> str:
    """`doc_tokens(doc_id, pos, k, token_id, ord)` in document order."""
    return """
doc_tokens AS MATERIALIZED (
  SELECT p.doc_id, p.pos, e.k, e.token_id,
         row_number() OVER (PARTITION BY p.doc_id ORDER BY p.pos, e.k) - 1 AS ord
  FROM ep_pieces p JOIN enc_piece_ids e USING (piece)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip())


# UTF-8 byte classes in upper-case hex, for decoding with replacement in SQL:
# whole valid sequences first, then truncated valid prefixes (one maximal
# subpart each), then any single byte.  Every alternative consumes whole bytes
# and the last always matches, so the scan stays on byte boundaries.
_C = "[89AB][0-9A-F]"
UTF8_VALID = (
    "[0-7][0-9A-F]|(?:C[2-9A-F]|D[0-9A-F])" + _C
    + "|E0[AB][0-9A-F]" + _C + "|(?:E[1-9A-CEF])" + _C + _C + "|ED[89][0-9A-F]" + _C
    + "|F0[9AB][0-9A-F]" + _C + _C + "|F[1-3]" + _C + _C + _C + "|F48[0-9A-F]" + _C + _C
)
UTF8_PREFIX = (
    "F0[9AB][0-9A-F]" + _C + "|F[1-3]" + _C + _C + "|F48[0-9A-F]" + _C
    + "|F0[9AB][0-9A-F]|F[1-3]" + _C + "|F48[0-9A-F]"
    + "|E0[AB][0-9A-F]|E[1-9A-CEF]" + _C + "|ED[89][0-9A-F]"
    + "|C[2-9A-F]|D[0-9A-F]|E[0-9A-F]|F[0-4]"
)


def utf8_decode_sql(hex_expr: str, replacement: str) -> str:
    """Decode a hex string as UTF-8; each invalid maximal subpart becomes
    `replacement` (U+FFFD for `replace`, '' for `ignore`)."""
    pattern = f"(?:{UTF8_VALID})|(?:{UTF8_PREFIX})|.."
    valid = f"^(?:{UTF8_VALID})$"
    return (
        f"array_to_string(list_transform(regexp_extract_all({hex_expr}, {q(pattern)}), "
        f"lambda x: CASE WHEN regexp_matches(x, {q(valid)}) THEN decode(unhex(x)) ELSE {q(replacement)} END), '')"
    )
