from collections import Counter

import public_tokenizers
from helpers import documents, frame
from tokenizers import Tokenizer

from tokenloom.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    library = Tokenizer.from_file(PATH)
    return Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)


def test_counts_equal_the_library(spark):
    got = token_counts(frame(spark), PATH).collect()
    assert Counter(map(tuple, got)) == expected(documents())


def test_small_head_leaves_the_rest_to_the_join(spark):
    got = token_counts(frame(spark), PATH, head_rows=5).collect()
    assert Counter(map(tuple, got)) == expected(documents())


def test_empty_table(spark):
    assert token_counts(frame(spark, []), PATH).collect() == []


def test_every_word_character_alone_and_in_words():
    """Parting at ASCII white space changes no count, whatever the character."""
    library = Tokenizer.from_file(PATH)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for cp in [*range(1, 0x530), *range(0x1E00, 0x2100), *range(0x3000, 0x3100), 0x1F600, 0x10940]:
        c = chr(cp)
        text = f"a{c}B 1{c} {c}{c}\t{c}'s\n{c}"
        parts = [p.decode() for p in text.encode().split()]
        assert count(text) == sum(map(count, parts)), hex(cp)
