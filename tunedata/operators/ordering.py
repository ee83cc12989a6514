"""Deterministic order, step plan and batch padding.

Global positions are computed without a window over the whole frame: the
order key is an md5 hex string, whose leading digits split the key space
into equal buckets in key order. Per-bucket counts (at most ``buckets`` rows)
give each bucket's offset; a row's position is its offset plus its rank
inside the bucket. Both passes are pure functions of the row, so a retried
task or a recomputed stage gives the same positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.functions.arrays import IGNORE_INDEX, repeat, round_up


# Rows of an offset table (two numbers each) that may be broadcast.
BROADCAST_BUCKETS = 1 << 20


def shuffle_key(key, seed: int | str) -> Column:
    """O1 with D4: ``md5('<seed>:<key>')`` - stable under any partitioning."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def with_position(df: DataFrame, bucket_col: str, order_cols, pos_col: str = "pos",
                  count_from: DataFrame | None = None, before: int | None = None,
                  max_buckets: int | None = None) -> DataFrame:
    """Dense 0-based position of each row in ``(bucket_col, *order_cols)`` order.

    ``bucket_col`` must be non-decreasing in that order and have far fewer
    distinct values than rows: its per-bucket counts are the only thing
    ordered as a whole. Each bucket is ranked in its own task. The offsets are
    broadcast where ``max_buckets`` bounds them by ``BROADCAST_BUCKETS``; else they
    are joined on the bucket, by which the window has to be partitioned anyway.
    ``count_from`` is an optional cheaper frame with the same ``bucket_col``
    multiset (e.g. the keys before an expensive per-row step), so that step
    is not computed a second time just to be counted. With ``before`` only the
    buckets that hold a position below it are kept.
    """
    counts = (count_from if count_from is not None else df).groupBy(bucket_col) \
        .agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(bucket_col, F.coalesce(F.sum("_n").over(
        Window.orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    if before is not None:
        offsets = offsets.filter(F.col("_off") < before)
    within = Window.partitionBy(bucket_col).orderBy(*order_cols)
    bounded = max_buckets is not None and max_buckets <= BROADCAST_BUCKETS
    return (df.join(F.broadcast(offsets) if bounded else offsets, bucket_col, "inner")
            .withColumn(pos_col, (F.col("_off") + F.row_number().over(within) - 1).cast("bigint"))
            .drop("_off"))


def with_hex_position(df: DataFrame, hex_col: str, tie_col: str, pos_col: str = "pos",
                      bucket_digits: int = 3, count_from: DataFrame | None = None) -> DataFrame:
    """Dense 0-based position of each row in ``(hex_col, tie_col)`` order.

    ``hex_col`` must be uniformly distributed hex (an md5), so the
    ``16**bucket_digits`` buckets are evenly filled; the offset table has at
    most that many rows - bounded by the parameter, not by the data.
    """
    if not 1 <= bucket_digits <= 5:
        raise ValueError("bucket_digits must be in 1..5")
    bucket = F.conv(F.substring(F.col(hex_col), 1, bucket_digits), 16, 10).cast("int")
    x = df.withColumn("_bucket", bucket)
    c = None if count_from is None else count_from.withColumn("_bucket", bucket)
    return with_position(x, "_bucket", [hex_col, tie_col], pos_col, c,
                         max_buckets=16 ** bucket_digits).drop("_bucket")


def shuffled_positions(df: DataFrame, key: str, seed: int | str, pos_col: str = "pos",
                       keys: DataFrame | None = None, bucket_digits: int = 3) -> DataFrame:
    """O1: rows in seeded md5 order of their unique ``key`` with their position.

    ``keys`` optionally holds the same ``key`` values as ``df`` from a cheaper
    plan; the bucket counts are taken from it.
    """
    k = shuffle_key(key, seed)
    count_from = None if keys is None else keys.select(k.alias("_shuffle_key"))
    return with_hex_position(df.withColumn("_shuffle_key", k), "_shuffle_key", key, pos_col,
                             bucket_digits, count_from).drop("_shuffle_key")


def assign_steps(df: DataFrame, pos_col: str, devices: int, per_device_batch: int,
                 grad_accum: int, max_steps: int | None = None) -> DataFrame:
    """W5 / L4 with rule D12.

    ``per_step = devices * per_device_batch * grad_accum``; ``step = pos div per_step``,
    ``q = pos mod per_step``, ``rank = q mod devices``,
    ``micro = (q div devices) div per_device_batch``. The last partial step is kept;
    rows past ``max_steps`` are left out (training stops there).
    """
    if min(devices, per_device_batch, grad_accum) < 1:
        raise ValueError("devices, per_device_batch and grad_accum must be >= 1")
    per_step = devices * per_device_batch * grad_accum
    p = F.col(pos_col)
    q = F.pmod(p, F.lit(per_step))
    out = df.select("*", F.floor(p / per_step).cast("int").alias("step"),
                    F.pmod(q, F.lit(devices)).cast("int").alias("rank"),
                    F.floor(F.floor(q / devices) / per_device_batch).cast("int").alias("micro"))
    if max_steps is not None:
        out = out.filter(F.col("step") < max_steps)
    return out


def step_plan(df: DataFrame, key: str, seed: int | str, devices: int, per_device_batch: int, grad_accum: int,
              max_steps: int | None = None, bucket_digits: int = 3) -> DataFrame:
    """O1 + W5 / L4: ``df`` with ``pos, step, rank, micro``; rows past ``max_steps`` are left out.

    The bucket offsets tell which buckets hold any wanted position, so the rest
    never reaches the shuffle that ranks the rows."""
    k = shuffle_key(key, seed)
    bucket = F.conv(F.substring("_k", 1, bucket_digits), 16, 10).cast("int")
    x = df.withColumn("_k", k).withColumn("_bucket", bucket)
    most = None if max_steps is None else max_steps * devices * per_device_batch * grad_accum
    pos = with_position(x, "_bucket", ["_k", key], "pos", before=most, max_buckets=16 ** bucket_digits).drop("_bucket", "_k")
    return assign_steps(pos, "pos", devices, per_device_batch, grad_accum, max_steps)


def collate_thin(seqs: DataFrame, steps: DataFrame, key: str, len_col: str, pad_id: int,
                 batch_cols=("step", "rank", "micro"), multiple: int = 8) -> DataFrame:
    """L3 / A7 in two parts: the padded length of each micro-batch from the thin rows of
    ``steps`` (``key``, ``len_col``, batch columns), then one join with the sequences, which
    are padded row by row. A key may be in several steps (epochs)."""
    batch = Window.partitionBy(*batch_cols)
    plan = steps.withColumn("padded_len", round_up(F.max(len_col).over(batch), multiple)).drop(len_col)
    x = seqs if "attention_mask" in seqs.columns else \
        seqs.withColumn("attention_mask", repeat(1, F.size("input_ids")))
    x = x.join(plan, key)
    n_pad = F.col("padded_len") - F.size("input_ids")
    arrays = ("input_ids", "labels", "attention_mask")
    return x.select(*[c for c in x.columns if c not in (*arrays, "padded_len")], "padded_len",
                    F.concat("input_ids", repeat(pad_id, n_pad)).alias("input_ids"),
                    F.concat("labels", repeat(IGNORE_INDEX, n_pad)).alias("labels"),
                    F.concat("attention_mask", repeat(0, n_pad)).alias("attention_mask"))


def collate(df: DataFrame, pad_id: int, batch_cols=("step", "rank", "micro"),
            multiple: int = 8) -> DataFrame:
    """Right-pad every row of a micro-batch to the batch's longest
    sequence rounded up to ``multiple``.

    ``input_ids`` get ``pad_id``, ``labels`` IGNORE_INDEX, ``attention_mask`` 0;
    a missing ``attention_mask`` counts as ones over the given ids. A batch has
    at most ``per_device_batch`` rows, so the window groups are small.
    """
    batch = Window.partitionBy(*batch_cols)
    x = df if "attention_mask" in df.columns else \
        df.withColumn("attention_mask", repeat(1, F.size("input_ids")))
    x = x.withColumn("padded_len", round_up(F.max(F.size("input_ids")).over(batch), multiple))
    n_pad = F.col("padded_len") - F.size("input_ids")
    return x.select(
        *[c for c in df.columns if c not in ("input_ids", "labels", "attention_mask")],
        "padded_len",
        F.concat("input_ids", repeat(pad_id, n_pad)).alias("input_ids"),
        F.concat("labels", repeat(IGNORE_INDEX, n_pad)).alias("labels"),
        F.concat("attention_mask", repeat(0, n_pad)).alias("attention_mask"))


def head_by_ordinal(df: DataFrame, ordinal: str, limit: int | None) -> DataFrame:
    """O2 / O3 (D10): the first ``limit`` rows by ordinal; ``None`` keeps all.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition keeps
    its own top ``limit`` rows, so only ``limit x partitions`` rows move.
    """
    ordered = df.orderBy(F.col(ordinal).asc())
    return ordered if limit is None else ordered.limit(limit)


def epoch_plan(df: DataFrame, key: str, seed: int | str, devices: int, per_device_batch: int,
               grad_accum: int, max_steps: int, n_rows: int | None = None,
               bucket_digits: int = 3) -> DataFrame:
    """W5 / L4 over several epochs, until ``max_steps`` steps are planned.

    Each epoch is its own seeded shuffle (``md5('<seed>:<epoch>:<key>')``);
    steps do not span epochs (an epoch's last partial step is kept, D12), so
    an epoch has ``ceil(n / per_step)`` steps and global step = epoch * that +
    step in the epoch. Only as many epochs as ``max_steps`` needs are made
    (one row copy per epoch; a large input needs a single epoch). Positions
    use the bucketed helper with the epoch as the leading bucket, so no
    window runs over the whole frame. Output adds ``epoch, pos, step, rank, micro``.
    """
    if min(devices, per_device_batch, grad_accum, max_steps) < 1:
        raise ValueError("devices, per_device_batch, grad_accum and max_steps must be >= 1")
    per_step = devices * per_device_batch * grad_accum
    n = df.count() if n_rows is None else n_rows
    if n == 0:
        nulls = [F.lit(None).cast(t).alias(c) for c, t in
                 (("epoch", "int"), ("pos", "bigint"), ("step", "int"), ("rank", "int"), ("micro", "int"))]
        return df.select("*", *nulls).limit(0)
    steps_per_epoch = -(-n // per_step)
    epochs = -(-max_steps // steps_per_epoch)
    x = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    k = F.md5(F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"), F.lit(":"),
                       F.col(key).cast("string")))
    x = x.withColumn("_k", k).withColumn(
        "_bucket", F.col("epoch").cast("bigint") * 16 ** bucket_digits
        + F.conv(F.substring("_k", 1, bucket_digits), 16, 10).cast("int"))
    # Global position of the first row past the last step: the last epoch is cut there.
    last = (epochs - 1) * n + (max_steps - (epochs - 1) * steps_per_epoch) * per_step
    x = with_position(x, "_bucket", ["_k", key], "_gpos", before=last,
                      max_buckets=epochs * 16 ** bucket_digits).drop("_bucket", "_k")
    pos = F.col("_gpos") - F.col("epoch").cast("bigint") * n
    q = F.pmod(pos, F.lit(per_step))
    out = x.select(
        *df.columns, F.col("epoch").cast("int").alias("epoch"), pos.alias("pos"),
        (F.col("epoch") * steps_per_epoch + F.floor(pos / per_step)).cast("int").alias("step"),
        F.pmod(q, F.lit(devices)).cast("int").alias("rank"),
        F.floor(F.floor(q / devices) / per_device_batch).cast("int").alias("micro"))
    return out.filter(F.col("step") < max_steps)
