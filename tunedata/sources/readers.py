"""Readers with explicit schemas.

JSON is read in PERMISSIVE mode with a corrupt-record column; rows that fail
to parse are split off with ``split_valid`` (quarantine) instead of killing
the job. The file suffix picks the reader (D7: unknown suffix is an error).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tunedata.functions.text import unquote_literal
from tunedata.sources.json_array import read_json_array

CORRUPT = "_corrupt"

PROMPT_SCHEMA = StructType([StructField(c, StringType(), True)
                            for c in ("input", "target", "type", "answer_choices", "sample_id")])
CHAT_SCHEMA = StructType([StructField("conversations", ArrayType(StructType([
    StructField("from", StringType(), True), StructField("value", StringType(), True)])), True)])
PREDICT_SCHEMA = StructType([StructField("instruction", ArrayType(StringType()), True),
                             StructField("input", StringType(), True)])
BENCHMARK_SCHEMA = StructType([StructField("item_id", LongType(), True),
                               StructField("text", StringType(), True)])
VOCAB_TSV_SCHEMA = "token string, score double"


def _with_corrupt(schema: StructType) -> StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])


def reader_kind(path: str) -> str:
    """``json`` for .json/.jsonl, ``txt`` for .txt, else ValueError."""
    p = path.rstrip("/").lower()
    if p.endswith(".json") or p.endswith(".jsonl"):
        return "json"
    if p.endswith(".txt"):
        return "txt"
    raise ValueError(f"unsupported file type: {path!r} (expected .json, .jsonl or .txt)")


def read_json(spark: SparkSession, path: str, schema: StructType, multiline: bool = False,
              array: bool = False) -> DataFrame:
    """JSON lines (or one top-level array: with ``array`` read by many tasks, with
    ``multiline`` a file in one)."""
    if array:
        return read_json_array(spark, path, schema, CORRUPT)
    return (spark.read.schema(_with_corrupt(schema))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multiline).json(path))


def read_examples(spark: SparkSession, path: str, schema: StructType = PROMPT_SCHEMA,
                  fmt: str | None = None, multiline: bool = False, array: bool = False) -> DataFrame:
    """``.json``/``.jsonl`` by suffix, any other path needs an explicit ``fmt``
    (parquet, orc, csv); there is no implicit download."""
    if fmt is None:
        kind = reader_kind(path)
        if kind != "json":
            raise ValueError(f"training examples must be JSON, got {path!r}")
        return read_json(spark, path, schema, multiline, array)
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.schema(schema).option("header", True)
    return r.load(path)


def read_validation(spark: SparkSession, path: str | None, schema: StructType = PROMPT_SCHEMA,
                    multiline: bool = False, array: bool = False) -> DataFrame | None:
    """S3: validation examples, or None when no path is given."""
    return None if path is None else read_json(spark, path, schema, multiline, array)


def split_valid(df: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): a row is quarantined when it failed to parse or a
    required column is NULL (D6)."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    for c in required or []:
        bad = bad | F.col(c).isNull()
    valid = df.filter(~bad)
    return (valid.drop(CORRUPT) if CORRUPT in df.columns else valid), df.filter(bad)


def chat_turns(chats: DataFrame, id_col: str | None = None) -> DataFrame:
    """Nested chat examples -> ``turns(conv_id, turn, role, value)``.

    ``posexplode_outer`` keeps a conversation without turns as one row with
    NULL ``turn`` (D20). Without an id column the id comes from
    ``monotonically_increasing_id`` (unique, not dense).
    """
    base = chats.withColumn("conv_id", F.col(id_col) if id_col else F.monotonically_increasing_id())
    t = base.select("conv_id", F.posexplode_outer("conversations").alias("turn", "s"))
    return t.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                    F.col("s.from").alias("role"), F.col("s.value").alias("value"))


def read_prompts_txt(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S5 / F-str-8 (D8): one quoted literal per line -> (``value``, quarantined lines).

    Lines are never evaluated; only string literals are accepted.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    parsed = lines.select("line", unquote_literal(F.col("line")).alias("value"))
    return parsed.filter(F.col("value").isNotNull()).select("value"), \
        parsed.filter(F.col("value").isNull()).select("line")


def _listing(spark: SparkSession, path: str, pattern: str | None = None) -> list[str] | None:
    """Entries of a folder, as its own file system has them (any store that Spark reads); None
    if ``path`` is no folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return None
    entries = fs.listStatus(p) if pattern is None else fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, pattern))
    return sorted(e.getPath().toString() for e in entries)


def read_corpus(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """A directory (all ``pattern`` files in it, on any store) or
    comma-separated paths."""
    if "," not in path and _listing(spark, path) is not None:
        return spark.read.option("pathGlobFilter", pattern).text(path)
    return spark.read.text([p for p in path.split(",") if p])


def vocab_paths(spark: SparkSession, path: str, suffix: str = ".vocab") -> list[str]:
    """The vocabularies at ``path``: itself, or for a folder of vocabularies its entries that
    end with ``suffix`` (a folder that itself has the suffix is one written vocabulary)."""
    if path.rstrip("/").endswith(suffix) or _listing(spark, path) is None:
        return [path]
    found = _listing(spark, path, f"*{suffix}")
    if not found:
        raise ValueError(f"no *{suffix} in {path!r}")
    return found


def read_vocab_tsv(spark: SparkSession, path, glob: str | None = "*.vocab") -> DataFrame:
    """``.vocab`` files (piece TAB score, no quoting) -> ``(token, score, ord, file)``.

    ``path`` is one path or a list; ``file`` is the full file path, so sources
    written by Spark (part files in one folder each) sort by their folder.

    ``ord`` is the line number inside the file (its id there). Line order comes
    from ``monotonically_increasing_id`` (increasing along a file's splits);
    the per-file window ranks one vocabulary, which its size bounds.
    """
    rd = spark.read.schema(VOCAB_TSV_SCHEMA).option("sep", "\t").option("quote", "").option("escape", "")
    rd = rd.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("lineSep", "\n")
    if glob:
        rd = rd.option("pathGlobFilter", glob)
    r = (rd.csv(path)
         .select("token", "score", F.col("_metadata.file_path").alias("file"),
                 F.monotonically_increasing_id().alias("_mono")))
    w = Window.partitionBy("file").orderBy("_mono")
    return r.withColumn("ord", (F.row_number().over(w) - 1).cast("int")).drop("_mono")
