import random
import zlib

from helpers import documents, frame, words

from tokenloom.llm.quality_knn import accepted, features, quality_scores


def corpus(n=300, seed=8):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = words(rng, rng.randint(20, 60), vocabulary)
        if not good:
            text = " ".join(w + rng.choice(["%%%", "###"]) for w in text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        rows.append((500 + i, text, "en", "s", 0, 0, 0, 0, ""))
        labels.append((500 + i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_rows(spark):
    rows, labels = corpus()
    all_rows = rows + documents()
    lab = spark.createDataFrame(labels + [(None, 1, 0), (501, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(frame(spark, all_rows), lab).collect()
    assert len(got) == len(all_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    y = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in y]
    assert len(held) > 50 and sum(r.predicted == y[r.doc_id] for r in held) / len(held) > 0.97
    again = quality_scores(frame(spark, all_rows, partitions=2), lab).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(r.doc_id), round(r.score, 6)) for r in again)


def test_held_out_labels_are_never_used(spark):
    rows, labels = corpus()
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    flipped = [(i, 1 - q if held(i) else q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a = quality_scores(frame(spark, rows), spark.createDataFrame(labels, schema)).collect()
    b = quality_scores(frame(spark, rows), spark.createDataFrame(flipped, schema)).collect()
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_scores(frame(spark), none).collect()
    assert {r.score for r in got} == {0.5}
    assert quality_scores(frame(spark, []), none).collect() == []
    kept = accepted(frame(spark), none)
    assert kept.columns == frame(spark).columns and kept.count() == len(documents())


def test_shape_of_a_long_word_is_of_all_of_it():
    one, other = "ab1" * 40 + "%%" * 30, "ab1" * 40 + "XY" * 30
    assert (features(one)[1] != features(other)[1]).any()
    assert (features(one)[1] == features("cd22" * 40 + "%" * 7)[1]).all()
