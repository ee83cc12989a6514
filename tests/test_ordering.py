from pyspark.sql import functions as F

from tunedata.operators import ordering
from tunedata.operators.ordering import assign_steps, collate, head_by_ordinal, shuffled_positions


def test_shuffle_is_permutation_and_partition_independent(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "key")
    a = {r.key: r.pos for r in shuffled_positions(df, "key", 42).collect()}
    b = {r.key: r.pos for r in shuffled_positions(df.repartition(13), "key", 42).collect()}
    assert a == b and sorted(a.values()) == list(range(2500))
    import hashlib
    want = sorted(range(2500), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert [k for k, _ in sorted(a.items(), key=lambda kv: kv[1])] == want
    c = {r.key: r.pos for r in shuffled_positions(df, "key", 7).collect()}
    assert c != a


def test_steps_64_64_2(spark):
    df = spark.range(0, 130).withColumnRenamed("id", "pos")
    s = assign_steps(df, "pos", 1, 4, 16)
    counts = {r.step: r["count"] for r in s.groupBy("step").count().collect()}
    assert counts == {0: 64, 1: 64, 2: 2}
    slots = s.select("step", "rank", "micro").groupBy("step", "rank", "micro").count()
    assert slots.agg(F.max("count")).first()[0] == 4
    assert assign_steps(df, "pos", 1, 4, 16, max_steps=2).count() == 128
    two = {(r.rank, r.micro) for r in assign_steps(df, "pos", 2, 4, 16).filter("step = 0").collect()}
    assert two == {(r, m) for r in (0, 1) for m in range(16)}


def test_collate_pads_to_multiple_of_8(spark):
    rows = [(i, list(range(1, n + 1)), [7] * n, [1] * n) for i, n in enumerate([5, 8, 9])]
    df = spark.createDataFrame(rows, "ex long, input_ids array<int>, labels array<int>, attention_mask array<int>")
    df = df.withColumn("step", F.lit(0)).withColumn("rank", F.lit(0)).withColumn("micro", F.lit(0))
    out = {r.ex: r for r in collate(df, pad_id=0).collect()}
    for ex, n in enumerate([5, 8, 9]):
        r = out[ex]
        assert r.padded_len == 16 and len(r.input_ids) == 16
        assert r.input_ids[n:] == [0] * (16 - n) and r.labels[n:] == [-100] * (16 - n)
        assert r.attention_mask == [1] * n + [0] * (16 - n)


def test_collate_fixed_pair_length_unchanged(spark):
    df = spark.createDataFrame([(0, [3] * 272, [3] * 272)], "ex long, input_ids array<int>, labels array<int>")
    df = df.withColumn("step", F.lit(0)).withColumn("rank", F.lit(0)).withColumn("micro", F.lit(0))
    r = collate(df, pad_id=0).first()
    assert r.padded_len == 272 and r.attention_mask == [1] * 272


def test_head_limit(spark):
    df = spark.range(0, 2001).withColumnRenamed("id", "ord").repartition(5)
    got = [r.ord for r in head_by_ordinal(df, "ord", 2000).collect()]
    assert got == list(range(2000))
    assert head_by_ordinal(df, "ord", None).count() == 2001


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 300), st.integers(1, 3), st.integers(1, 5), st.integers(1, 4))
def test_every_example_has_one_slot(spark, n, devices, per_device, accum):
    df = spark.range(0, n).withColumnRenamed("id", "key")
    s = assign_steps(shuffled_positions(df, "key", 1), "pos", devices, per_device, accum).collect()
    assert sorted(r.key for r in s) == list(range(n))
    per_step = devices * per_device * accum
    slots = {}
    for r in s:
        assert r.step == r.pos // per_step and 0 <= r.rank < devices and 0 <= r.micro < accum
        slots.setdefault((r.step, r.rank, r.micro), []).append(r.key)
    assert all(len(v) <= per_device for v in slots.values())
    assert len({r.step for r in s}) == -(-n // per_step)


def test_epoch_plan_repeats_until_max_steps(spark):
    from tunedata.operators.ordering import epoch_plan
    df = spark.range(0, 130).withColumnRenamed("id", "key").repartition(3)
    rows = epoch_plan(df, "key", 42, 1, 4, 16, max_steps=5).collect()
    per_step = {}
    for r in rows:
        per_step[r.step] = per_step.get(r.step, 0) + 1
    assert per_step == {0: 64, 1: 64, 2: 2, 3: 64, 4: 64}
    e0 = sorted((r.pos, r.key) for r in rows if r.epoch == 0)
    assert [p for p, _ in e0] == list(range(130)) and sorted(k for _, k in e0) == list(range(130))
    e1 = [k for _, k in sorted((r.pos, r.key) for r in rows if r.epoch == 1)]
    assert len(e1) == 128 and e1 != [k for _, k in e0][:128]
    one = epoch_plan(df, "key", 42, 1, 4, 16, max_steps=2).collect()
    assert len(one) == 128 and {r.epoch for r in one} == {0}


def test_offsets_beyond_the_bound_are_joined(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "k")
    want = sorted(map(tuple, ordering.epoch_plan(df, "k", 42, 1, 4, 16, 30).collect()))
    monkeypatch.setattr(ordering, "BROADCAST_BUCKETS", 10)
    plan = ordering.epoch_plan(df, "k", 42, 1, 4, 16, 30)
    assert sorted(map(tuple, plan.collect())) == want
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()


def test_step_plan_drops_buckets_before_the_shuffle(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    every = ordering.step_plan(df, "k", 42, 2, 4, 3)
    some = ordering.step_plan(df, "k", 42, 2, 4, 3, max_steps=5)
    assert sorted(map(tuple, some.collect())) == sorted(tuple(r) for r in every.collect() if r["step"] < 5)
    assert "_off" in some._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["pos"] for r in every.collect()) == list(range(3000))
