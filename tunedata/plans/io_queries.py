"""Registered queries of the readers and jobs that need files: arrays, folders, quarantine, resume."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tunedata.operators import predict, profiles, vocab
from tunedata.operators.layouts import pair_layout
from tunedata.plans import training
from tunedata.plans.catalog import PROFILE, SOURCE_LEN, SQL_PAIRS, SQL_WORDS, TARGET_LEN, _big, register
from tunedata.session import scratch_path, ship_package
from tunedata.sources import readers, sinks, tables
from tunedata.sources.outputs import Outputs, finished_parts

ARRAY_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's objects as the lines of one JSON array."""
    before = "["
    for b in batches:
        lines = [before + v if i == 0 else "," + v for i, v in enumerate(b.column("value").to_pylist())]
        if lines:
            before = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"], pa.string())], ["value"])


@register("json_array_read", """
SELECT CAST(doc_id AS BIGINT) AS doc_id, md5(text) AS text_md5, lang FROM documents""")
def q_json_array_read(spark, sf):
    """Documents as top-level JSON arrays, read back by tasks that start anywhere in a file."""
    ship_package(spark)
    path = scratch_path(spark, "json-array")
    docs = tables.table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "text", "lang")).alias("value"))
    docs.mapInArrow(_as_array, "value string").write.text(path)
    back = readers.read_json(spark, path, ARRAY_SCHEMA, array=True)
    valid, _ = readers.split_valid(back, ["doc_id"])
    return valid.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@register("corpus_folder", f"""
SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({SQL_WORDS}) GROUP BY word""")
def q_corpus_folder(spark, sf):
    """Documents as a folder of text files, read as a corpus; words of all of them."""
    path = scratch_path(spark, "corpus")
    tables.table(spark, sf, "documents").select("text").write.text(path)
    return vocab.word_counts(readers.read_corpus(spark, path)).select("word", _big("n"))


PREVIEW_ROWS = 5


@register("preview_rows", f"""
SELECT CAST(example_id AS BIGINT) AS example_id,
       md5(regexp_replace(left(prompt, {SOURCE_LEN - 1}) || left(response, {TARGET_LEN - 2}),
                          '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')) AS decoded_md5
FROM ({SQL_PAIRS}) ORDER BY example_id LIMIT {PREVIEW_ROWS}""")
def q_preview_rows(spark, sf):
    """The first tokenized rows by key with their text, as the training job shows them."""
    p = tables.pairs(spark, sf)
    seqs = pair_layout(p, SOURCE_LEN, TARGET_LEN, PROFILE.bos_id, PROFILE.eos_id, PROFILE.pad_id, keep=["example_id"])
    rows = training.preview(seqs, n=PREVIEW_ROWS)
    shown = spark.createDataFrame([(r["example_id"], r["decoded"]) for r in rows], "example_id bigint, decoded string")
    return shown.select("example_id", F.md5("decoded").alias("decoded_md5"))


MODEL_PATHS = (("hub/pythia-12b-deduped//", "pythia"), ("bloomz-7b1", "bloom"), ("/models/x/open_llama_7b/", "llama"))


@register("document_special_ids", """
SELECT CAST(doc_id AS BIGINT) AS doc_id, model_name, CAST(bos AS BIGINT) AS bos_id, CAST(eos AS BIGINT) AS eos_id,
       CAST(pad AS BIGINT) AS pad_id
FROM documents JOIN (VALUES (0, 'pythia-12b-deduped', 0, 0, 1), (1, 'bloomz-7b1', 1, 2, 3), (2, 'open_llama_7b', 1, 2, 0))
     m(k, model_name, bos, eos, pad) ON doc_id % 3 = k""")
def q_document_special_ids(spark, sf):
    """J1, J2, F-str-4: documents meant for several models, each row with the special ids of its own."""
    path, kind = (F.element_at(F.array(*[F.lit(m[i]) for m in MODEL_PATHS]), (F.col("doc_id") % 3 + 1).cast("int"))
                  for i in range(2))
    docs = tables.table(spark, sf, "documents").select("doc_id", path.alias("path"), kind.alias("kind"))
    found = profiles.attach_special_ids(docs, "path", "kind")
    return found.select(_big("doc_id"), "model_name", _big("bos_id"), _big("eos_id"), _big("pad_id"))


FAILS_ON = 97


def failing_model() -> predict.Predictor:
    """The stand-in model, failing on batches that hold a prompt whose length is a multiple of ``FAILS_ON``."""
    def answer(prompts):
        if any(len(p) % FAILS_ON == 0 for p in prompts):
            raise ValueError("the model fails on this prompt")
        return [p + p[::-1] for p in prompts]

    return answer


@register("predict_quarantine", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(text) % {FAILS_ON} = 0 AS BIGINT) AS failed,
       CASE WHEN length(text) % {FAILS_ON} <> 0 THEN md5(replace(text || reverse(text), text, '')) END AS prediction_md5
FROM documents""")
def q_predict_quarantine(spark, sf):
    """F3 with bad rows: a prompt that the model fails on costs that row alone."""
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    done = predict.batch_predict(docs, "text", failing_model, error_col="error")
    return done.select(_big("doc_id"), F.col("error").isNotNull().cast("bigint").alias("failed"),
                       F.md5("prediction").alias("prediction_md5"))


class _Stopped(Exception):
    pass


@register("resumed_job", """
SELECT lang, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(('0x' || left(md5(doc_id || ':' || text), 8))::BIGINT) AS BIGINT) AS text_sum
FROM documents GROUP BY lang""")
def q_resumed_job(spark, sf):
    """K3, K6: documents by language as parts of one commit; the job stops inside of its second part and is
    started again, which keeps the first part and replaces the half-written one."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "resumed")
    parts = {"even": F.col("doc_id") % 2 == 0, "odd": F.col("doc_id") % 2 != 0}

    def run(stop: bool) -> Outputs:
        job = Outputs(spark, path, {"source": sf})

        def write(name: str, at: str) -> None:
            rows = docs.filter(parts[name])
            if stop and name == "odd":
                sinks.write_sequences(rows.filter("doc_id % 3 = 0"), at, overwrite=True)
                raise _Stopped
            sinks.write_sequences(rows, at, overwrite=True)

        for name in parts:
            job.part(name, lambda at, name=name: write(name, at))
        job.commit()
        return job

    try:
        run(True)
    except _Stopped:
        pass
    if run(False).kept != ["even"]:
        raise AssertionError("the finished part was written again")
    back = spark.read.parquet(*[f"{path}/{name}" for name in finished_parts(spark, path)])
    digest = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text")), 1, 8), 16, 10)
    return back.groupBy("lang").agg(F.count("*").alias("n_rows"), F.sum(digest.cast("bigint")).alias("text_sum"))
