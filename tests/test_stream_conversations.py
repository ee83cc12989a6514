import random

import pytest

from tunedata.operators.layouts import chat_layout
from tunedata.streaming.conversations import chat_layout_stream

SCHEMA = "conv_id bigint, turn bigint, role string, value string, ts timestamp"


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for conv in range(25):
        for turn in range(rng.choice([1, 2, 5, 12])):
            rows.append((conv, turn, rng.choice(["human", "gpt"]), "x" * rng.randint(0, 30) + f" {conv}:{turn}",
                         f"2024-01-01 00:{rng.randint(0, 9):02d}:{rng.randint(0, 59):02d}"))
    return rows


def put(spark, rows, path):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, value string, ts string")
    df.selectExpr("conv_id", "turn", "role", "value", "cast(ts as timestamp) as ts").coalesce(1).write.mode("append").json(path)


def run(spark, source, sink, ckpt):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    out = chat_layout_stream(src, 64, 2, delay="1 hour", idle_seconds=60)
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_batch_layout_for_any_arrival_and_restart(spark, turns, scratch, seed):
    source, sink, ckpt = scratch("turns"), scratch("layout"), scratch("layout-state")
    mixed = turns[:]
    random.Random(seed).shuffle(mixed)
    for part in range(2):
        put(spark, mixed[part::4], source)
    run(spark, source, sink, ckpt)  # stopped with half of the turns, started again with the rest
    assert spark.read.parquet(sink).count() == 0
    for part in range(2, 4):
        put(spark, mixed[part::4], source)
    # Later turns of another conversation move the watermark on.
    put(spark, [(999, 0, "human", "later", "2024-01-02 00:00:00")], source)
    put(spark, [(999, 1, "gpt", "later", "2024-01-02 00:00:01")], source)
    run(spark, source, sink, ckpt)
    put(spark, [(1000, 0, "human", "end", "2024-01-02 00:00:02")], source)
    run(spark, source, sink, ckpt)
    df = spark.createDataFrame([r[:4] for r in turns], "conv_id bigint, turn bigint, role string, value string")
    want = {r["conv_id"]: tuple(r) for r in chat_layout(df, 64, 2).collect()}
    got = [tuple(r) for r in spark.read.parquet(sink).collect()]
    assert len(got) == len(want) and {r[0]: r for r in got} == want
