"""Encoding and decoding text columns with a vocabulary table.

A vocabulary whose measured size is within ``MAX_DICTIONARY_BYTES`` is sent once
to every executor (a Spark broadcast), and texts are encoded row by row in Arrow
batches: no token rows, no shuffle, so the encoders also run on a stream. A larger
one is joined instead: one row per word, an equi-join with the vocabulary
(AQE splits skewed keys), and the ids collected in word order. Equal rows are
counted first, encoded once and repeated, so keys need not be unique.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.functions.codec import WORD_MARK, words
from tunedata.operators.vocab import UNK_ID
from tunedata.session import ship_package, slices

# Largest dictionary that is sent to every executor: UTF-8 bytes of its tokens
# and this many for each entry.
MAX_DICTIONARY_BYTES, ENTRY_BYTES = 32 << 20, 100
# Distinct words whose pieces a worker remembers.
REMEMBERED_WORDS = 200_000


def dictionary(vocab: DataFrame, max_bytes: int = MAX_DICTIONARY_BYTES) -> list | None:
    """The vocabulary's rows if its measured size is within ``max_bytes``, else None."""
    size = vocab.agg(F.sum(F.octet_length("token") + ENTRY_BYTES)).first()[0] or 0
    return vocab.select("token", "id", "score", "kind").collect() if size <= max_bytes else None


def _map_column(df: DataFrame, col: str, out: str, kind: str, arrow: pa.DataType, make, arrays: bool = False) -> DataFrame:
    """``df`` with ``out = make()(value of col)`` for each row, in Arrow batches; ``arrays`` is for functions of
    an Arrow array of values that give one."""
    ship_package(df.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out)
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in (part for whole in batches for part in slices(whole)):
            made = fn(b.column(col)) if arrays else pa.array([fn(v) for v in b.column(col).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], made], [*kept, out])

    return df.mapInArrow(run, f"{fields}, `{out}` {kind}")


# ------------------------------------------------------------- word encoder
def word_tokens(df: DataFrame, key: str, text_col: str, vocab: DataFrame, unk_id: int = UNK_ID, keep=(),
                outer: bool = False) -> DataFrame:
    """One row per word: ``(key, keep..., pos, token, id, is_unk)``; unknown words get ``unk_id``.

    With ``outer`` a row without words survives once with NULL ``pos``.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    w = df.select(key, *keep, explode(words(F.col(text_col))).alias("pos", "word"))
    w = w.select(key, *keep, "pos", F.concat(F.lit(WORD_MARK), F.col("word")).alias("token"))
    j = w.join(vocab.select("token", F.col("id").alias("_vid")), "token", "left")
    return j.select(key, *keep, "pos", "token", F.coalesce("_vid", F.lit(unk_id)).alias("id"),
                    F.col("_vid").isNull().alias("is_unk"))


def _ordered(pos: str, value: str):
    """Collect ``value`` in ``pos`` order, skipping the NULL-pos row of an empty input."""
    item = F.when(F.col(pos).isNotNull() & F.col(value).isNotNull(), F.struct(pos, value))
    return F.array_sort(F.collect_list(item))


def _distinct_rows(df: DataFrame, key: str, col: str, content) -> DataFrame:
    """Distinct rows of ``key, col`` with their number ``_copies`` and the hash ``_row`` of ``content``."""
    rows = df.groupBy(*dict.fromkeys([key, col])).agg(F.count(F.lit(1)).alias("_copies"))
    return rows.withColumn("_row", F.sha2(content, 256))


def _each_copy(df: DataFrame, *cols) -> DataFrame:
    """``cols`` of ``df``, once for each of the row's ``_copies``."""
    return df.select(*cols, F.explode(F.array_repeat(F.lit(True), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")


def word_ids(df: DataFrame, text_col: str, rows: list, out: str = "ids", unk_id: int = UNK_ID) -> DataFrame:
    """``df`` with the word ids of ``text_col`` by the dictionary ``rows``; no words give []."""
    mark = len(WORD_MARK)
    by_word = {r["token"][mark:].encode(): r["id"] for r in rows if r["token"].startswith(WORD_MARK)}
    shared = df.sparkSession.sparkContext.broadcast(by_word)

    def make():
        known = shared.value.get
        # Of bytes, split() cuts at ASCII white space only.
        return lambda text: [known(w, unk_id) for w in text.encode().split()] if text else []

    return _map_column(df, text_col, out, "array<int>", pa.list_(pa.int32()), make)


def encode_words(df: DataFrame, key: str, text_col: str, vocab: DataFrame, unk_id: int = UNK_ID,
                 max_bytes: int = MAX_DICTIONARY_BYTES) -> DataFrame:
    """V6: ``(key, ids ARRAY<INT>)`` per row, in word order; a text without words gives []."""
    rows = dictionary(vocab, max_bytes)
    if rows is not None:
        return word_ids(df.select(key, text_col), text_col, rows, "ids", unk_id).select(key, "ids")
    t = word_tokens(_distinct_rows(df, key, text_col, F.col(text_col)), key, text_col, vocab, unk_id,
                    keep=("_row", "_copies"), outer=True)
    g = t.groupBy(key, "_row", "_copies").agg(_ordered("pos", "id").alias("_p"))
    return _each_copy(g, key, F.transform("_p", lambda s: s["id"]).cast("array<int>").alias("ids"))


def decode_ids(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, skip_special: bool = True,
               max_bytes: int = MAX_DICTIONARY_BYTES) -> DataFrame:
    """``(key, text)``: pieces in order, word marks become spaces,
    the leading one is dropped; special pieces are skipped when asked, unknown ids always."""
    v = vocab.filter(F.col("kind") != "special") if skip_special else vocab
    rows = dictionary(v, max_bytes)
    if rows is not None:
        shared = df.sparkSession.sparkContext.broadcast({r["id"]: r["token"] for r in rows})

        def make():
            piece = shared.value.get

            def text(ids) -> str:
                whole = "".join([piece(i, "") for i in ids or ()]).replace(WORD_MARK, " ")
                return whole[1:] if whole.startswith(" ") else whole

            return text

        return _map_column(df.select(key, ids_col), ids_col, "text", "string", pa.string(), make).select(key, "text")
    rows = _distinct_rows(df, key, ids_col, F.to_json(ids_col))
    e = rows.select(key, "_row", "_copies", F.posexplode_outer(F.col(ids_col)).alias("pos", "id"))
    j = e.join(v.select("id", "token"), "id", "left")
    g = j.groupBy(key, "_row", "_copies").agg(_ordered("pos", "token").alias("_p"))
    text = F.array_join(F.transform("_p", lambda s: s["token"]), "")
    text = F.regexp_replace(F.regexp_replace(text, WORD_MARK, " "), "\\A ", "")
    return _each_copy(g, key, text.alias("text"))


# ------------------------------------------------------------ piece encoder
def _joined(symbols: list, scores: dict) -> list:
    """Repeatedly join the adjacent pair whose concatenation is the piece with the highest
    score, leftmost on ties. A heap of candidate pairs; stale ones are skipped."""
    after = [*range(1, len(symbols)), -1]
    before = list(range(-1, len(symbols) - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        score = scores.get(symbols[i] + symbols[j]) if j >= 0 else None
        if score is not None:
            heapq.heappush(heap, (-score, i, symbols[i], symbols[j]))

    for i in range(len(symbols) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j], after[i] = a + b, None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in symbols if s is not None]


class PieceEncoder:
    """Subword encoder of whole texts: the text is cut at the user symbols (atomic), then into
    words; a part that begins a word carries the word mark."""

    def __init__(self, rows: list, unk_id: int):
        scores = {r["token"]: r["score"] for r in rows if r["kind"] == "normal"}
        ids = {r["token"]: r["id"] for r in rows if r["kind"] != "special"}
        symbols = sorted((r["token"] for r in rows if r["kind"] == "user_defined"), key=len, reverse=True)
        self.ids, self.unk_id = ids, unk_id
        self.cut = re.compile("(" + "|".join(map(re.escape, symbols)) + ")").split if symbols else lambda t: [t]

        @lru_cache(REMEMBERED_WORDS)
        def part_ids(part: bytes, marked: bool) -> tuple:
            start = [WORD_MARK] if marked else []
            return tuple(ids.get(p, unk_id) for p in _joined(start + list(part.decode()), scores))

        self.part_ids = part_ids

    def __call__(self, text: str | None) -> list:
        out: list = []
        begins = True  # the next part begins a word
        for n, piece in enumerate(self.cut(text or "")):
            if n % 2:
                if begins:
                    out.append(self.ids.get(WORD_MARK, self.unk_id))
                out.append(self.ids[piece])
                begins = False
                continue
            raw = piece.encode()
            if not raw:
                continue
            for k, w in enumerate(raw.split()):
                out += self.part_ids(w, begins or k > 0 or raw[:1].isspace())
            begins = begins and not raw.strip() or raw[-1:].isspace()
        return out


def encode_pieces(df: DataFrame, key: str, text_col: str, vocab: DataFrame, unk_id: int = UNK_ID,
                  max_bytes: int = MAX_DICTIONARY_BYTES) -> DataFrame:
    """V6 with a subword vocabulary: ``(key, ids ARRAY<INT>)`` per row.

    One beyond ``max_bytes`` stays a table that the distinct words are joined with (``pieces``).
    """
    rows = dictionary(vocab, max_bytes)
    if rows is None:
        from tunedata.operators import pieces
        return pieces.joined_ids(df, key, text_col, vocab, unk_id=unk_id, cutter=pieces.WordCutter)
    shared = df.sparkSession.sparkContext.broadcast(rows)
    return _map_column(df.select(key, text_col), text_col, "ids", "array<int>", pa.list_(pa.int32()),
                       lambda: PieceEncoder(shared.value, unk_id)).select(key, "ids")


# ------------------------------------------------------- user-supplied encoder
_ENCODERS: dict = {}


def encode_callable(df: DataFrame, text_col: str, factory, out_col: str = "ids",
                    batch_size: int = 256) -> DataFrame:
    """F2 (c): encode ``text_col`` with any user encoder ``list[str] -> list[list[int]]``.

    The encoder is built once per Python worker by ``factory`` and called on
    Arrow batches (``mapInPandas``); every input column passes through.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
    ship_package(df.sparkSession)
    schema = StructType(df.schema.fields + [StructField(out_col, ArrayType(IntegerType()), True)])
    key = uuid.uuid4().hex  # of this call: other closures or parameters never share an encoder

    def run(batches):
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = factory()
        enc = _ENCODERS[key]
        for pdf in batches:
            texts = pdf[text_col].tolist()
            out: list = []
            for i in range(0, len(texts), batch_size):
                chunk = texts[i:i + batch_size]
                res = [list(map(int, ids)) for ids in enc(chunk)]
                if len(res) != len(chunk):
                    raise RuntimeError(f"encoder returned {len(res)} rows for {len(chunk)}")
                out.extend(res)
            yield pdf.assign(**{out_col: out})

    return df.mapInPandas(run, schema)
