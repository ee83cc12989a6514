"""Binary ``.model`` vocabularies (S7, K4, K5): the protocol-buffer wire format, read and written.

A file is a sequence of fields: field 1, repeated, is a piece (1 text, 2 score, 3 type), all
others are settings of the trainer and the normaliser, which are kept as bytes. Files are read
by Spark's ``binaryFile`` source, so from any store it reads; writing goes through the store's own
file system. A vocabulary is bounded by its ``vocab_size``, so is the file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.session import ship_package

# The piece types of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
KINDS = {NORMAL: "normal", UNKNOWN: "special", CONTROL: "special", USER_DEFINED: "user_defined", UNUSED: "unused",
         BYTE: "byte"}
# Numbers of fields and of model types. Trainer: model type 3, vocabulary size 4, byte fallback 35.
# Normaliser: name 1, mark before the text 3, white space runs cut 4, spaces as marks 5.
PIECES, TRAINER, NORMALISER = 1, 2, 3
MODEL_TYPES = {"unigram": 1, "bpe": 2, "word": 3, "char": 4}
VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5
MODEL_SCHEMA = "token string, id int, score double, kind string, type int, file string"


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(raw):
            raise ValueError("the file ends inside a number")
        b = raw[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def fields(raw: bytes) -> Iterator[tuple[int, int, object, bytes]]:
    """``(field, wire type, value, the field's own bytes)`` one after the other."""
    at = 0
    while at < len(raw):
        start = at
        tag, at = _varint(raw, at)
        field, wire = tag >> 3, tag & 7
        if wire == VARINT:
            value, at = _varint(raw, at)
        elif wire == BYTES:
            size, at = _varint(raw, at)
            value, at = raw[at:at + size], at + size
        elif wire in (FIXED64, FIXED32):
            size = 8 if wire == FIXED64 else 4
            value, at = raw[at:at + size], at + size
        else:
            raise ValueError(f"unknown wire type {wire}")
        if at > len(raw):
            raise ValueError("the file ends inside a field")
        yield field, wire, value, raw[start:at]


def parse(raw: bytes) -> tuple[list, bytes]:
    """Pieces ``(text, score, type)`` in id order, and the bytes of all other fields."""
    pieces, rest = [], []
    for field, wire, value, own in fields(raw):
        if field != PIECES or wire != BYTES:
            rest.append(own)
            continue
        text, score, kind = "", 0.0, NORMAL
        for f, _, v, _ in fields(value):
            if f == 1:
                text = v.decode()
            elif f == 2:
                score = struct.unpack("<f", v)[0]
            elif f == 3:
                kind = v
        pieces.append((text, score, kind))
    return pieces, b"".join(rest)


def serialize(pieces: list, rest: bytes = b"") -> bytes:
    out = bytearray()
    for text, score, kind in pieces:
        raw = text.encode()
        body = b"\x0a" + _number(len(raw)) + raw + b"\x15" + struct.pack("<f", score)
        if kind != NORMAL:
            body += b"\x18" + _number(kind)
        out += b"\x0a" + _number(len(body)) + body
    return bytes(out) + rest


def _binary(spark: SparkSession, path) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def read_model(spark: SparkSession, path) -> DataFrame:
    """``token, id, score, kind, type, file`` of the ``.model`` files at ``path`` (a path, a list or a
    folder of them). Scores are single precision, as in the file; ``type`` keeps the file's own number."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, name in zip(b.column("content"), b.column("path"), strict=True):
                pieces, _ = parse(raw.as_py())
                text, score, kind = zip(*pieces, strict=True) if pieces else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text, pa.string()), pa.array(range(len(text)), pa.int32()), pa.array(score, pa.float64()),
                     pa.array([KINDS.get(k, "unused") for k in kind], pa.string()), pa.array(kind, pa.int32()),
                     pa.array([name.as_py()] * len(text), pa.string())],
                    ["token", "id", "score", "kind", "type", "file"])

    return _binary(spark, path).select("content", "path").mapInArrow(run, MODEL_SCHEMA)


def settings(spark: SparkSession, path: str) -> bytes:
    """The fields of one ``.model`` file that are no pieces, as they are."""
    row = _binary(spark, path).select("content").first()
    if row is None:
        raise ValueError(f"no file at {path!r}")
    return parse(bytes(row["content"]))[1]


def piece_type(columns: list):
    """A row's type: its own, else by its kind; ``<unk>`` among special pieces is the unknown one."""
    by_kind = (F.when(F.col("kind") == "special", F.when(F.col("token") == "<unk>", UNKNOWN).otherwise(CONTROL))
               .when(F.col("kind") == "user_defined", USER_DEFINED).when(F.col("kind") == "byte", BYTE)
               .when(F.col("kind") == "unused", UNUSED).otherwise(NORMAL))
    return F.coalesce(F.col("type"), by_kind) if "type" in columns else by_kind


def plain_settings(model_type: str, size: int, byte_fallback: bool) -> bytes:
    """Settings of a vocabulary trained here: texts as they are, spaces as marks, one more before the text."""
    def field(number: int, value: int) -> bytes:
        return _number(number << 3 | VARINT) + _number(value)

    def message(number: int, body: bytes) -> bytes:
        return _number(number << 3 | BYTES) + _number(len(body)) + body

    trainer = field(3, MODEL_TYPES[model_type]) + field(4, size) + field(35, int(byte_fallback))
    name = b"identity"
    normaliser = _number(1 << 3 | BYTES) + _number(len(name)) + name + field(3, 1) + field(4, 0) + field(5, 1)
    return message(TRAINER, trainer) + message(NORMALISER, normaliser)


def write_model(vocab: DataFrame, path: str, like: str | None = None, overwrite: bool = False,
                model_type: str = "bpe") -> None:
    """One ``.model`` file of ``vocab`` (``token, id, score, kind`` and, if at hand, ``type``) in id order.
    ``like`` names a file whose settings the new one takes over, as a merged model does its base's; else
    they are those of a vocabulary of ``model_type`` trained here."""
    spark = vocab.sparkSession
    rows = vocab.select("token", "id", "score", piece_type(vocab.columns).alias("type")).orderBy("id").collect()
    if [r["id"] for r in rows] != list(range(len(rows))):
        raise ValueError("the ids of a model are its piece numbers, 0, 1, 2, ...")
    rest = settings(spark, like) if like else plain_settings(model_type, len(rows), any(r["type"] == BYTE for r in rows))
    raw = serialize([(r["token"], r["score"], r["type"]) for r in rows], rest)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, overwrite)
    try:
        out.write(bytearray(raw))
    finally:
        out.close()
