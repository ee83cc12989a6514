"""The physical plans keep the properties the scale design relies on."""

import re

from pyspark.sql import functions as F

from tunedata.operators import encode, layouts, ordering, vocab
from tunedata.operators.predict import batch_predict, echo_reverse
from tunedata.sources import tables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_layout_adds_no_shuffle(spark):
    conv = tables.table(spark, SF, "conversations").select("conv_id", F.col("text").alias("prompt"),
                                                           F.col("text").alias("response"))
    plan = _plan(layouts.pair_layout(conv, 256, 16, 0, 0, 1, keep=["conv_id"]))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<conv_id:bigint,text:string>" in plan


def test_chat_layout_one_shuffle_with_partial_group_limit(spark):
    plan = _plan(layouts.chat_layout(tables.turns(spark, SF), 512, 2, ("user",)))
    assert plan.count("Exchange") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit sits below (before) the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_scan_prunes_columns(spark):
    docs = tables.table(spark, SF, "documents")
    plan = docs.select("doc_id").filter("doc_id > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,3)]" in plan


def test_positions_have_no_unpartitioned_window_over_rows(spark):
    docs = tables.table(spark, SF, "documents").select("doc_id")
    plan = _plan(ordering.shuffled_positions(docs, "doc_id", 42))
    # the only window without partition keys is over the per-bucket counts,
    # which reach it through a broadcast
    assert "BroadcastExchange" in plan
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert any("_bucket" in w for w in windows)


def test_encoders_move_no_tokens(spark):
    docs = tables.table(spark, SF, "documents").select("doc_id", "text")
    v = vocab.word_vocab(docs.select(F.col("text").alias("value")), vocab_size=1000)
    ids = encode.encode_words(docs, "doc_id", "text", v)
    for df in (ids, encode.decode_ids(ids, "doc_id", "ids", v), encode.encode_pieces(docs, "doc_id", "text", v)):
        plan = _plan(df)
        assert "MapInArrow" in plan and "Exchange" not in plan and "Generate" not in plan
    plan = _plan(encode.encode_words(docs, "doc_id", "text", v, max_bytes=10))
    assert "Generate" in plan and "Join" in plan and "MapInArrow" not in plan


def test_arrays_cross_one_exchange_when_batched(spark):
    from tunedata.plans.training import TrainingData, batches
    cfg = TrainingData("x/pythia-1b-deduped", "pythia", max_steps=10)
    pairs = tables.pairs(spark, SF).select("example_id", F.lit([1, 2]).alias("input_ids"), F.lit([1, 2]).alias("labels"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(batches(pairs, cfg, 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = [w for w in plan.splitlines() if re.search(r"\bWindow \[", w)]
    assert windows and not any("labels" in w for w in windows)


def test_word_counts_pre_aggregate_before_shuffle(spark):
    docs = tables.table(spark, SF, "documents").select(F.col("text").alias("value"))
    plan = _plan(vocab.word_counts(docs))
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_prediction_runs_in_arrow_batches(spark):
    b = tables.table(spark, SF, "benchmark").select(F.col("text").alias("value"))
    plan = _plan(batch_predict(b, "value", echo_reverse))
    assert "MapInPandas" in plan and "BatchEvalPython" not in plan


def test_epoch_plan_ranks_within_buckets(spark):
    docs = tables.table(spark, SF, "documents").select("doc_id")
    plan = _plan(ordering.epoch_plan(docs, "doc_id", 42, 1, 4, 16, 10))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert any("_bucket" in w for w in windows) and "BroadcastExchange" in plan
