"""One top-level JSON array read by many tasks.

``multiLine`` puts a file into one task. Here the file is read as text that ends at every
``}``, which Spark splits anywhere; what a split means depends on the quotes, escapes and
brackets before it, so the work goes in two passes:

1. Every split becomes a map: for each state it may start in (outside of strings, inside, inside
   behind a backslash) the state it ends in and the change of depth. Maps of a file's splits,
   one small row each, are composed in order, which gives every split's true start.
2. Every split is walked from its start: records that lie inside of it come out whole, and at most
   one piece of a record on either side of it. These pieces are joined in order, by record.

Elements that are no objects, and text that is no JSON array, come out as they are, to be
read as corrupt records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tunedata.session import materialize, ship_package

OUTSIDE, INSIDE, ESCAPED = range(3)
# Outside of strings quotes and brackets matter (between elements also commas), inside of them quotes and backslashes.
PLAIN, ELEMENT, QUOTED = re.compile(r'["{}\[\]]'), re.compile(r'["{}\[\],]'), re.compile(r'["\\]')
END = "}"
# The starts of all splits are broadcast, one small row each; more splits than this are an error.
MAX_SPLITS = 1_000_000
# What a row of a split is: the end of an element begun before it, all of an element, the whole split inside
# of one element, the begin of one that goes on.
HEAD, WHOLE, MIDDLE, TAIL = range(4)


def scan(text: str, state: int) -> tuple[int, int]:
    """State behind ``text`` from ``state`` before it, and the change of depth."""
    depth = at = 0
    if state == ESCAPED and text:
        at, state = 1, INSIDE
    while at < len(text):
        m = (PLAIN if state == OUTSIDE else QUOTED).search(text, at)
        if m is None:
            break
        c, at = m.group(), m.end()
        if c == '"':
            state = INSIDE if state == OUTSIDE else OUTSIDE
        elif c == "\\":
            if at == len(text):
                return ESCAPED, depth
            at += 1
        else:
            depth += 1 if c in "{[" else -1
    return state, depth


class Walker:
    """Cuts a split into elements of the top-level array (depth 1), from its true start."""

    def __init__(self, state: int, depth: int):
        self.state, self.depth = state, depth
        self.parts: list = []
        self.whole = depth < 2 and state == OUTSIDE  # nothing of an element was before

    def feed(self, text: str) -> Iterator[tuple[int, str]]:
        """The elements that end in ``text``, with the place of each."""
        at = begin = 0
        while at < len(text):
            if self.state == ESCAPED:
                self.state, at = INSIDE, at + 1
                continue
            m = (QUOTED if self.state == INSIDE else ELEMENT if self.depth == 1 else PLAIN).search(text, at)
            if m is None:
                break
            c, at = m.group(), m.end()
            if c == '"':
                self.state = INSIDE if self.state == OUTSIDE else OUTSIDE
            elif c == "\\":
                if at == len(text):
                    self.state = ESCAPED
                else:
                    at += 1
            else:
                self.depth += (c in "{[") - (c in "}]")
                # A comma between elements, the begin of the array, or its end.
                if c == "," or c in "{[" and self.depth == 1 or c in "}]" and self.depth == 0:
                    yield from self._end(text[begin:at - 1])
                    begin = at
        self.parts.append(text[begin:])

    def _end(self, text: str) -> Iterator[tuple[int, str]]:
        self.parts.append(text)
        element, whole = "".join(self.parts), self.whole
        self.parts, self.whole = [], True
        if not whole or element.strip():
            yield (WHOLE if whole else HEAD), element

    def rest(self) -> tuple[int, str]:
        return (TAIL if self.whole else MIDDLE), "".join(self.parts)


def _pieces(spark: SparkSession, path) -> DataFrame:
    meta = F.col("_metadata")
    return (spark.read.option("lineSep", END).text(path)
            .select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
                    meta["file_size"].alias("size"), F.col("value").cast("binary").alias("value")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str, int, int]]:
    """The rows in order as ``((file, block), text, bytes, file's bytes)``, each text with the end sign that
    Spark cut off."""
    for b in batches:
        for file, block, size, raw in zip(*(b.column(c).to_pylist() for c in ("file", "block", "size", "value")), strict=True):
            yield (file, block), raw.decode("utf-8", "replace") + END, len(raw) + 1, size


MAP_SCHEMA = "file string, block bigint, size bigint, ends array<int>, depths array<bigint>, bytes bigint, head string"


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: its map, its bytes, and the first sign that is no white space."""
    now: dict = {}
    for (file, block), text, n, size in _texts(batches):
        if (file, block) != (now.get("file"), now.get("block")):
            if now:
                yield _map_row(now)
            now = {"file": file, "block": block, "size": size, "states": [(OUTSIDE, 0), (INSIDE, 0), (ESCAPED, 0)],
                   "bytes": 0, "head": ""}
        now["states"] = [(end, depth + change) for state, depth in now["states"] for end, change in [scan(text, state)]]
        now["bytes"] += n
        now["head"] = now["head"] or text.lstrip("﻿ \t\r\n")[:1]
    if now:
        yield _map_row(now)


def _map_row(now: dict) -> pa.RecordBatch:
    columns = [now["file"], now["block"], now["size"], [s for s, _ in now["states"]], [d for _, d in now["states"]],
               now["bytes"], now["head"]]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)],
                                      [c.split()[0] for c in MAP_SCHEMA.split(", ")])


def _starts(rows: pd.DataFrame) -> pd.DataFrame:
    """True start of each split of one file: its maps composed in order. A file that does not end with the
    end sign was read as one byte longer: its last split is ``open``."""
    rows = rows.sort_values("block")
    if rows["head"].iloc[0] != "[":
        raise ValueError(f"{rows['file'].iloc[0]} is no JSON array")
    state, depth, out = OUTSIDE, 0, []
    for ends, depths in zip(rows["ends"], rows["depths"], strict=True):
        out.append((state, depth))
        state, depth = int(ends[state]), depth + int(depths[state])
    longer = bool(rows["bytes"].sum() > rows["size"].iloc[0])
    return pd.DataFrame({"file": rows["file"], "block": rows["block"], "state": [s for s, _ in out],
                         "depth": [d for _, d in out], "open": [False] * (len(out) - 1) + [longer]})


def read_elements(spark: SparkSession, path) -> DataFrame:
    """``file, element`` (text) of the top-level arrays at ``path``, in no fixed order."""
    ship_package(spark)
    pieces = _pieces(spark, path)
    # One row a split; a file's rows meet in one task (a file has few splits beside its size).
    maps = pieces.mapInArrow(_maps, MAP_SCHEMA)
    starts = maps.groupBy("file").applyInPandas(_starts, "file string, block bigint, state int, depth bigint, open boolean")
    rows = starts.limit(MAX_SPLITS + 1).collect()
    if len(rows) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; raise spark.sql.files.maxPartitionBytes")
    known = spark.sparkContext.broadcast({(r["file"], r["block"]): (r["state"], r["depth"], r["open"]) for r in rows})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key, rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(rows), pa.string()), pa.array([key[1]] * len(rows), pa.int64()),
                 pa.array([p for p, _ in rows], pa.int32()), pa.array([e for _, e in rows], pa.string())],
                ["file", "block", "place", "element"])

        def last(key, walker, held, rows):
            rows += walker.feed(held[:-len(END)] if known.value[key][2] else held)
            return made(key, [*rows, walker.rest()])

        now, walker, rows, held = None, None, [], ""
        for key, text, _, _ in _texts(batches):  # a text is held until the next one shows that it wasn't the last
            if key != now:
                if now is not None:
                    yield last(now, walker, held, rows)
                now, walker, rows = key, Walker(*known.value[key][:2]), []
            else:
                rows += walker.feed(held)
            held = text
            if len(rows) >= 1000:
                yield made(now, rows)
                rows = []
        if now is not None:
            yield last(now, walker, held, rows)

    parts = materialize(pieces.mapInArrow(walk, "file string, block bigint, place int, element string"), how="table")
    whole = parts.filter(F.col("place") == WHOLE).select("file", "element")
    # Per split at most two rows are left: the end of an element begun before, the begin of one that goes on.
    order = Window.partitionBy("file").orderBy("block", "place")
    begun = F.sum((F.col("place") == TAIL).cast("int")).over(order)
    broken = (parts.filter(F.col("place") != WHOLE).withColumn("record", begun)
              .withColumn("at", F.row_number().over(order)).groupBy("file", "record")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "element"))),
                                            lambda s: s["element"]), "").alias("element")))
    return whole.unionByName(broken.select("file", "element"))


def read_json_array(spark: SparkSession, path, schema: StructType, corrupt: str = "_corrupt") -> DataFrame:
    """Rows of the arrays' elements with ``schema``; an element that is no object of it keeps its text in
    ``corrupt``, as in Spark's permissive mode."""
    full = schema if corrupt in schema.fieldNames() else StructType([*schema.fields, StructField(corrupt, StringType(), True)])
    text = F.regexp_replace("element", r"(?s)\A\s+|\s+\z", "")
    rows = read_elements(spark, path).select(text.alias("element")).filter(F.col("element") != "")
    made = F.from_json("element", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return rows.select(made.alias("r")).select("r.*")
