"""What a Python worker holds at a time is bounded, however large the batches that Spark hands to it."""

import pyarrow as pa

from tunedata.operators import encode, pieces, predict
from tunedata.session import BATCH_ROWS, SLICE_BYTES, SLICE_ROWS, ship_package, slices


def _captured(monkeypatch, df) -> list:
    """The functions that ``mapInArrow`` is called with."""
    runs: list = []
    real = type(df).mapInArrow

    def capture(self, run, *args, **kwargs):
        runs.append(run)
        return real(self, run, *args, **kwargs)

    monkeypatch.setattr(type(df), "mapInArrow", capture)
    return runs


def test_slices_are_all_of_a_batch():
    short = pa.RecordBatch.from_arrays([pa.array(range(5000))], ["i"])
    long = pa.RecordBatch.from_arrays([pa.array(["x" * (1 << 18)] * 40)], ["i"])
    for batch in (short, long, short.slice(0, 1), short.slice(0, 0)):
        parts = list(slices(batch))
        assert [v for p in parts for v in p.column("i").to_pylist()] == batch.column("i").to_pylist()
        assert all(0 < p.num_rows <= SLICE_ROWS for p in parts)
    assert max(p.num_rows for p in slices(long)) <= SLICE_BYTES // (1 << 18)


def test_arrow_batches_of_the_session(spark):
    ship_package(spark)
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS


def test_encoders_work_on_slices(spark, monkeypatch):
    rows = [("▁aa", 1, -1.0, "normal"), ("▁", 2, -2.0, "normal"), ("a", 3, -3.0, "normal")]
    v = spark.createDataFrame([("<unk>", 0, 0.0, "special"), *rows], "token string, id int, score double, kind string")
    docs = spark.createDataFrame([(1, "aa a")], "k long, text string")
    runs = _captured(monkeypatch, docs)
    encode.encode_words(docs, "k", "text", v)
    big = pa.RecordBatch.from_arrays([pa.array(range(5000), pa.int64()), pa.array(["aa a"] * 5000)], ["k", "text"])
    made = list(runs[0](iter([big])))
    assert sum(b.num_rows for b in made) == 5000 and max(b.num_rows for b in made) <= SLICE_ROWS
    runs.clear()
    assert [r["ids"] for r in pieces.joined_ids(docs, "k", "text", v).collect()] == [[2, 3, 3, 2, 3]]
    made = list(runs[0](iter([big.rename_columns(["_row", "_text"])])))
    assert sum(b.num_rows for b in made) == 5000 and max(b.num_rows for b in made) <= SLICE_ROWS


def test_long_prompts_are_taken_few_at_a_time(spark):
    def batch_size():
        return lambda prompts: [f"{p}{len(prompts)}" for p in prompts]

    size = predict.SORTED_CHARS // 4 + 1
    df = spark.createDataFrame([(i, "x" * (size if i < 16 else 1)) for i in range(40)], "k int, prompt string").coalesce(1)
    done = predict.batch_predict(df, "prompt", batch_size).select("k", "prediction").collect()
    assert [r["k"] for r in done] == list(range(40))
    assert [int(r["prediction"]) for r in done] == [4] * 16 + [24] * 24
