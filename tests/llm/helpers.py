"""Small tables with every awkward row, shared by the tests of the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, fp long, copies long, TOKENS string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def documents(seed=3, n=40):
    """Documents with null, empty and very long texts, repeated rows, equal ids,
    null ids and sources, odd white space and special strings; and extra columns
    named like the operators' own."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 7))) for _ in range(300)] + ["The", "of", "it's", "x1"]
    rows = []
    for i in range(n):
        lines = [words(rng, rng.randint(3, 25), vocabulary) + "." for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines), "en", f"src{i % 4}"))
    base = rows[5][1]
    rows += [
        (100, base, "en", "src1"),  # an exact copy
        (101, base.replace(base.split()[3], "changed", 1), "en", "src2"),  # a near copy
        (102, None, "en", None),
        (103, "", None, "src1"),
        (104, " \t\n ", "en", "src2"),
        (105, words(rng, 9000, vocabulary), "en", "src0"),  # very long
        (106, "a<|endoftext|>b <|endoftext|>  c  \t d\r\n e f \x1c g\u0085h", "en", "ÿ"),
        (107, "THE!! OF!! " * 30, "en", "src3"),
        (107, "THE!! OF!! " * 30, "en", "src3"),  # a repeated row
        (108, "日本語 текст 🙃 ﬁ İstanbul ΣΑΣ é ½ ²", "ja", "src0"),
        (None, "no id at all but five words", "en", "src0"),
        (109, "x", "en", "src1"),
    ]
    return [(d, t, la, s, len(t or ""), 7, 7, 7, "clash") for d, t, la, s in rows]


def frame(spark, rows=None, partitions=3):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)


def stored(spark, path, rows=None):
    """A table read from files, as the operators that scan twice need it."""
    frame(spark, rows).write.parquet(str(path))
    return spark.read.parquet(str(path))
