"""Batch prediction plan: read (JSON lines or txt literals) -> first ``limit``
rows in file order -> prompt -> predictor -> strip prompt -> JSON lines +
settings sidecar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.operators.ordering import head_by_ordinal
from tunedata.operators.predict import PredictorFactory, batch_predict, with_settings
from tunedata.operators.templates import assemble_prompt, txt_output
from tunedata.session import materialize
from tunedata.sources import readers, sinks

ORD = "_ord"


def _with_file_order(df: DataFrame) -> DataFrame:
    """Ordinal = (file name, position in the file): file names sort, ids increase
    along a file's splits."""
    return df.withColumn(ORD, F.struct(F.col("_metadata.file_name").alias("f"),
                                       F.monotonically_increasing_id().alias("i")))


def _lines(spark: SparkSession, data_file: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines with all their keys: (``raw, instruction, input``, quarantined lines).

    ``raw`` is the object as it stands in the file. ``instruction`` is an array or a
    string (D9); lines that are no object, or lack a text, are quarantined.
    """
    lines = spark.read.text(data_file).filter(F.trim("value") != "")
    raw = F.trim("value")
    obj = F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT")
    many = F.from_json(raw, "instruction array<string>, input string")
    one = F.from_json(raw, "instruction string, input string")
    x = lines.select("*", raw.alias("raw"), F.coalesce(obj, F.lit(False)).alias("_obj"), many["instruction"].alias("_many"),
                     one["instruction"].alias("_one"), one["input"].alias("input"))
    x = x.withColumn("instruction", F.coalesce("_many", F.array("_one")))
    bad = ~F.col("_obj") | F.col("input").isNull() | (F.col("_many").isNull() & F.col("_one").isNull())
    return x.filter(~bad), x.filter(bad).select(F.col("value").alias("line"))


def predictions(spark: SparkSession, data_file: str, factory: PredictorFactory,
                limit: int | None = None, batch_size: int = 64, first_char: bool = False,
                error_col: str | None = None, profile=None) -> tuple[DataFrame, DataFrame]:
    """(predictions, quarantined input lines) for one input file.

    With ``error_col`` the predictions have that column, and rows the predictor fails on
    stay among them without a prediction; ``profile`` is the predictor stage's resource profile.

    Of JSON lines the prediction frame has ``raw`` (the input object with all its
    keys), ``instruction``, ``input`` and ``prediction``. Without a limit nothing is
    sorted; with one, the rows it picks are dealt over the cluster again before
    the predictor runs.
    """
    def head(df: DataFrame) -> DataFrame:
        if limit is None:
            return df
        return head_by_ordinal(_with_file_order(df), ORD, limit).drop(ORD).repartition(
            max(2, spark.sparkContext.defaultParallelism))

    if readers.reader_kind(data_file) == "txt":
        ok, bad = readers.read_prompts_txt(spark, data_file)
        done = batch_predict(head(ok), "value", factory, batch_size, error_col=error_col, profile=profile)
        kept = txt_output(done, "value", "prediction")
        return (kept if error_col is None else done.select(
            F.col("value").alias("Input"), F.col("prediction").alias("Output"), error_col)), bad
    ok, bad = _lines(spark, data_file)
    ok = head(ok)
    if first_char:  # what indexing a string does
        ok = ok.withColumn("instruction", F.when(F.col("_many").isNull(), F.array(F.substring("_one", 1, 1)))
                           .otherwise(F.col("instruction")))
    prompted = assemble_prompt(ok.select("raw", "instruction", "input"), out_col="_prompt")
    return batch_predict(prompted, "_prompt", factory, batch_size, error_col=error_col, profile=profile).drop("_prompt"), bad


def with_prediction(preds: DataFrame) -> DataFrame:
    """``value``: every input object as it was, ``prediction`` added as its last key."""
    quoted = F.regexp_extract(F.to_json(F.array("prediction")), r"(?s)\A\[(.*)\]\z", 1)
    body = F.regexp_replace("raw", r"\s*\}\s*\z", "")
    comma = F.when(F.trim(body) == "{", "").otherwise(",")
    return preds.select(F.concat(body, comma, F.lit('"prediction":'), quoted, F.lit("}")).alias("value"))


def run(spark: SparkSession, data_file: str, output_path: str, factory: PredictorFactory,
        settings: dict | None = None, limit: int | None = None, batch_size: int = 64,
        overwrite: bool = False, preview: int = 0, quarantine_failures: bool = False, profile=None) -> list:
    """K1 + K2: ``<out>/generation_results`` (JSON lines: every key of the input and
    ``prediction``) and ``<out>/generation_config``. A factory that takes an argument
    gets the settings. Returns the first ``preview`` inputs.

    With ``quarantine_failures`` a row that the predictor fails on costs that row alone: its
    input and the error go to ``<out>/failed``."""
    full = {**sinks.DEFAULT_SETTINGS, **(settings or {})}
    error_col = "_error" if quarantine_failures else None
    preds, bad = predictions(spark, data_file, with_settings(factory, full), limit, batch_size, error_col=error_col,
                             profile=profile)
    if quarantine_failures:
        preds = materialize(preds, how="table")  # the predictor runs once for both outputs
        source = "raw" if "raw" in preds.columns else "Input"
        failed = preds.filter(F.col(error_col).isNotNull()).select(F.col(source).alias("line"), F.col(error_col).alias("error"))
        sinks.write_predictions(failed, f"{output_path}/failed", overwrite)
        preds = preds.filter(F.col(error_col).isNull()).drop(error_col)
    first = spark.read.text(data_file).limit(preview).collect() if preview else []
    if "raw" in preds.columns:
        sinks.write_lines(with_prediction(preds), f"{output_path}/generation_results", overwrite)
    else:
        sinks.write_predictions(preds, f"{output_path}/generation_results", overwrite)
    sinks.write_predictions(bad, f"{output_path}/quarantine", overwrite)
    sinks.write_settings(spark, settings or {}, f"{output_path}/generation_config", overwrite)
    return [r["value"] for r in first]
