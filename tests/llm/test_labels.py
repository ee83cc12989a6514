from pyspark.sql import functions as F

from tunedata.llm import labels


def sample(spark, docs, marks, **options):
    d = spark.createDataFrame([(*x, "k") for x in docs], "doc_id bigint, text string, label string")
    m = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    return sorted(tuple(r) for r in labels.labelled_sample(d, m, "toxic", F.lit(True), **options).collect())


def test_repeated_ids_give_one_row_each(spark):
    """Most rows repeat two labelled ids: the sample stays within its bound."""
    docs = [(i, f"text {i}") for i in range(100)] + [(i % 2, f"copy {i}") for i in range(20_000)]
    marks = [(i, i % 2) for i in range(100)] + [(0, 0)] * 50
    got = sample(spark, docs, marks, per_class=50)
    assert len(got) == 100 and [r[0] for r in got] == list(range(100))
    assert got[0] == (0, min(t for i, t in docs if i == 0), 0)
    assert len(sample(spark, docs, marks, per_class=7)) == 14


def test_bytes_are_bounded(spark):
    docs = [(i, "é" * 500) for i in range(40)] + [(40, "x" * 1_000_000)]
    marks = [(i, i % 2) for i in range(41)]
    got = sample(spark, docs, marks, per_class=50, max_bytes=10_000)
    assert 0 < sum(len(r[1].encode()) for r in got) <= 10_000
    assert got == sample(spark, docs[::-1], marks[::-1], per_class=50, max_bytes=10_000)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "no id"), (3, "a"), (4, "b")]
    marks = [(1, 0), (2, 1), (None, 1), (3, None), (4, 2), (9, 1)]
    assert sample(spark, docs, marks, per_class=5) == [(1, "", 0), (2, "", 1)]
    assert sample(spark, [], marks, per_class=5) == [] == sample(spark, docs, [], per_class=5)
