"""Session helpers: one place for the configs every plan relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tunedata",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    submitter decides them and AQE coalesces small shuffle partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Remove checkpoint files once their RDD is gone (BPE writes one per round).
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests) without the
    setting gets a folder of its own; on a cluster a missing setting is an
    error, since a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):  # one process, so any folder is shared
        own = tempfile.mkdtemp(prefix="tunedata-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once and cut its lineage (survives lost executors).

    ``checkpoint`` (default) is a reliable eager ``checkpoint()`` in the
    shared ``spark.checkpoint.dir`` (one job that computes and writes);
    ``table`` writes a parquet table below that folder and reads it back
    (columnar and compressed, but each read lists files and footers: slower
    for small per-round tables). For derived tables read by several branches
    of a plan or by every round of a loop, which Spark would otherwise
    recompute.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()

# Most rows of an Arrow batch that Spark hands to a Python worker, and the most rows and (by the
# batch's mean) bytes of it that are Python objects at a time.
BATCH_ROWS, SLICE_ROWS, SLICE_BYTES = 1024, 256, 1 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts (nothing is copied), so that what a worker makes of one does not grow with the input."""
    rows = max(1, min(SLICE_ROWS, SLICE_BYTES * batch.num_rows // max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def ship_package(spark: SparkSession) -> None:
    """Make ``tunedata`` importable in the Python workers (once per context).

    Functions run in ``mapInPandas`` refer to this package's modules, which
    workers import by name; the package is zipped on the driver and added
    with ``addPyFile``, which distributes it to every executor. Arrow batches of
    the session get ``BATCH_ROWS`` rows at most.
    """
    import os
    import zipfile
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="tunedata-py-"), "tunedata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(target)
    _SHIPPED.add(key)
