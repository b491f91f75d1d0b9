import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import documents, frame
from tokenizers import Tokenizer

from tokenloom.llm import cutting_stock, packing

PATH, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def ids_of(rows):
    library = Tokenizer.from_file(PATH)
    return [library.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows]


def check(rows, pieces, length=2048):
    """Each id in exactly one piece, checksums right, offsets gapless, sequences within length."""
    expected = defaultdict(list)
    for r, ids in zip(rows, ids_of(rows)):
        expected[r[0]].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
    assert set(got) == set(expected)
    for doc, copies in expected.items():
        ids, n = copies[0], len(copies)
        assert all(c == ids for c in copies)
        covered = np.zeros(len(ids), dtype=int)
        for p in got[doc]:
            part = ids[p.start : p.start + p.length]
            assert len(part) == p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(array("I", part).tobytes())
            covered[p.start : p.start + p.length] += 1
        assert (covered == n).all()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return sum(p.length for p in pieces) / (len(sequences) * length)


def test_pieces(spark):
    rows = documents()
    for ranks in (None, RANKS):
        pieces = packing.pack(frame(spark, rows), PATH, ranks=ranks).collect()
        assert check(rows, pieces) > 0.85
    assert packing.pack(frame(spark, []), PATH).collect() == []


def test_many_equal_lengths_are_cut_to_fill(spark):
    """A hot group of one length that fills no sequence alone."""
    rows = [(i, "the " * 1500, "en", "s", 0, 0, 0, 0, "") for i in range(300)]
    pieces = packing.pack(frame(spark, rows), PATH).collect()
    assert check(rows, pieces) > 0.97


def test_plan_holds_every_item_once():
    rng = np.random.default_rng(0)
    cuts = list(range(16, 256, 16))
    for counts in (rng.poisson(3, 256), np.where(np.arange(256) == 187, 4000, rng.integers(0, 9, 256)), np.eye(256, dtype=int)[255], np.zeros(256, dtype=int)):
        patterns, made = cutting_stock.plan(counts, cuts)
        packing.Places(patterns, made, counts)  # raises if an item is missing
        assert all(p @ (1 + np.arange(256)) <= 256 for p, _ in patterns)
        bins, least = sum(n for _, n in patterns), (counts @ (1 + np.arange(256))) / 256
        assert bins <= 1.03 * least + 2


def test_checksums_of_parts():
    data = bytes(range(256)) * 20
    for at in (0, 4, 512, 4000):
        assert packing.crc_of_second(zlib.crc32(data), zlib.crc32(data[:at]), len(data) - at) == zlib.crc32(data[at:])


def test_units_encode_as_in_the_text():
    coder = packing.Encoder(PATH, RANKS)
    odd = [0x1C, 0x85, 0xA0, 0xB2, 0x130, 0x3A3, 0x558, 0x1680, 0x180E, 0x200B, 0x2028, 0x3000, 0xFEFF, 0x10940, 0x1F643]
    for cp in [*range(1, 0x250), *odd]:
        c = chr(cp)
        text = f"a {c}b{c} c  {c} {c}\n x{c} <|endoftext|> {c}'s 1{c} "
        expected = array("I", coder.library.encode(text, add_special_tokens=False).ids).tobytes()
        assert coder.ids(text) == expected, hex(cp)
