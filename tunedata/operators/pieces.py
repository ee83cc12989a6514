"""Lossless subword encoding (V6, V7): merges or best paths, bytes for what the vocabulary lacks.

``text_ids`` encodes whole texts so that decoding gives them back to the character: every space
is a word mark, one more mark stands before the text, other white space is an ordinary
character, and a character without a piece becomes its UTF-8 bytes (pieces ``<0x00>`` to
``<0xFF>`` of kind ``byte``). Without byte pieces such a character is one unknown id. A
literal mark in the text is always written in bytes, since a mark means a space.

* ``bpe``: adjacent symbols are joined by the highest score, leftmost on ties.
* ``unigram``: the path of the highest sum of scores; of equal sums the one whose last piece is
  shorter, and so on backwards.

A vocabulary whose measured size is within the bound is broadcast. A larger one stays a table:
texts go in chunks, the substrings of a chunk's distinct words that may be pieces are joined with
the table, and each of the words is encoded once with the pieces found. A chunk is one row, so
what is shuffled are compressed chunks and a row for each chunk and piece, never one for a word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from tunedata.functions.codec import WORD_MARK
from tunedata.operators.bpe_train import FIRST_MADE, Pairs, _pair_keys
from tunedata.operators.encode import REMEMBERED_WORDS, _joined, _map_column
from tunedata.operators.vocab import UNK_ID
from tunedata.session import materialize, ship_package, slices

# Largest vocabulary that is broadcast: bytes of its tokens and so many for each entry.
MAX_BROADCAST_BYTES, ENTRY_BYTES = 32 << 20, 100
# What an unknown character costs a path beyond the worst piece.
UNKNOWN_COST = 10.0
MARK_BYTES = WORD_MARK.encode()
INTS = ArrayType(IntegerType())
# Bits that tell substrings that are no pieces before the join (2 MB, whatever the vocabulary).
FILTER_BITS = 1 << 24


def byte_piece(b: int) -> str:
    return f"<0x{b:02X}>"


def with_byte_pieces(vocab: DataFrame) -> DataFrame:
    """``vocab`` and the 256 byte pieces, with ids behind its own; existing byte pieces stay as they are."""
    spark = vocab.sparkSession
    rows = spark.createDataFrame([(byte_piece(b), b, 0.0, "byte") for b in range(256)],
                                 "token string, b int, score double, kind string")
    known = vocab.filter(F.col("kind") == "byte").select("token")
    last = vocab.agg((F.max("id") + 1).alias("last"))
    fresh = rows.join(known, "token", "left_anti").join(F.broadcast(last))
    return vocab.select("token", "id", "score", "kind").unionByName(
        fresh.select("token", (F.coalesce("last", F.lit(0)) + F.col("b")).cast("int").alias("id"), "score", "kind"))


def best_path(text: str, scores: dict, longest: int, unknown: float) -> list:
    """Pieces of the path of the highest sum of scores over ``text``."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        top, step = best[end - 1] + scores.get(text[end - 1:end], unknown), 1
        for n in range(2, min(longest, end) + 1):
            score = scores.get(text[end - n:end])
            if score is not None and best[end - n] + score > top:
                top, step = best[end - n] + score, n
        best.append(top)
        back.append(step)
    out, end = [], len(text)
    while end:
        out.append(text[end - back[end]:end])
        end -= back[end]
    return out[::-1]


class Segmenter:
    """Ids of a word (a mark and what follows up to the next one) by the pieces it is given."""

    def __init__(self, pieces: dict, byte_ids: list | None, unk_id: int, model_type: str, worst: float):
        self.ids = {t: i for t, (i, _) in pieces.items()}
        self.scores = {t: s for t, (_, s) in pieces.items()}
        self.byte_ids, self.unk_id = byte_ids, unk_id
        self.longest = max(map(len, pieces), default=1)
        self.unknown, self.unigram = worst - UNKNOWN_COST, model_type == "unigram"

    def bytes_of(self, raw: bytes) -> list:
        return [self.byte_ids[b] for b in raw] if self.byte_ids else [self.unk_id]

    def __call__(self, word: str) -> tuple:
        found = (best_path(word, self.scores, self.longest, self.unknown) if self.unigram
                 else _joined(list(word), self.scores))
        out: list = []
        for piece in found:
            known = self.ids.get(piece)
            out += self.bytes_of(piece.encode("utf-8", "surrogatepass")) if known is None else [known]
        return tuple(out)


# Longest word that is encoded with others at a time: one pair of each is joined per round.
LONG_WORD = 64


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The parts of ``pool`` at ``starts``, one behind the other."""
    ends = np.cumsum(lengths)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


class Joiner:
    """``Segmenter`` of many words at a time, for ``bpe``: a round joins the best pair of each word, leftmost
    on ties. A symbol is a code point, or ``FIRST_MADE`` and the place of its piece."""

    def __init__(self, pieces: dict, segment: Segmenter):
        self.segment = segment
        long = [t for t in pieces if len(t) > 1]
        number = {t: FIRST_MADE + i for i, t in enumerate(long)} | {t: ord(t) for t in pieces if len(t) == 1}
        keys, products = [], []
        for token in long:
            for cut in range(1, len(token)):
                a, b = token[:cut], token[cut:]
                x = ord(a) if cut == 1 else number.get(a)
                y = ord(b) if cut == len(token) - 1 else number.get(b)
                if x is not None and y is not None:
                    keys.append(x << 32 | y)
                    products.append(number[token])
        self.products = np.array(products, np.int64)
        self.pairs = Pairs(np.array(keys, np.int64))
        rank = np.unique([-float(pieces[t][1]) for t in long], return_inverse=True)[1] if long else np.zeros(0, np.int64)
        self.rank = rank[self.products - FIRST_MADE].astype(np.int64)
        self.made_ids = np.array([pieces[t][0] for t in long], np.int64)
        chars = sorted(ord(t) for t in pieces if len(t) == 1)
        self.chars = np.array(chars, np.int64)
        self.char_ids = np.array([pieces[chr(c)][0] for c in chars], np.int64)

    def __call__(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words``, one word behind the other, and how many each has."""
        size = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero(size <= LONG_WORD)
        text = "".join([words[i] for i in short.tolist()])
        flat, counts = self.ids_of(*self.joined(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64), size[short]))
        if len(short) == len(words):
            return flat, counts
        others = np.flatnonzero(size > LONG_WORD)
        found = [self.segment(words[i]) for i in others.tolist()]
        pool = np.concatenate([flat, *(np.array(f, np.int64) for f in found)])
        lengths = np.zeros(len(words), np.int64)
        lengths[short], lengths[others] = counts, [len(f) for f in found]
        order = np.concatenate([short, others])
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return _gathered(pool, starts, lengths), lengths

    def joined(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left of each word, and their numbers."""
        whole = np.arange(len(lengths))  # the words that still change
        out_codes, out_words = [], []
        while len(lengths):
            keys, word = _pair_keys(codes, lengths)
            places, at = self.pairs.find(keys)
            if not len(places):
                out_codes.append(codes)
                out_words.append(whole[word])
                break
            of = word[places]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.minimum.reduceat(self.rank[at] << 40 | np.arange(len(places)), first) & ((1 << 40) - 1)
            codes[places[best]] = self.products[at[best]]
            open_ = np.zeros(len(lengths), bool)
            open_[of[first]] = True
            left = np.ones(len(codes), bool)
            left[places[best] + 1] = False
            done = ~open_[word]
            out_codes.append(codes[done])
            out_words.append(whole[word[done]])
            codes = codes[left & ~done]
            lengths, whole = lengths[open_] - 1, whole[open_]
        if not out_codes:
            return codes, lengths
        codes, words = np.concatenate(out_codes), np.concatenate(out_words)
        order = np.argsort(words, kind="stable")
        return codes[order], words[order]

    def ids_of(self, codes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, the bytes of characters without a piece, and how many each word has."""
        ids, sizes = np.empty(len(codes), np.int64), np.ones(len(codes), np.int64)
        made = codes >= FIRST_MADE
        ids[made] = self.made_ids[codes[made] - FIRST_MADE]
        at = np.searchsorted(self.chars, codes)
        known = np.append(self.chars, -1)[at] == codes
        ids[known] = self.char_ids[at[known]]
        starts = np.arange(len(codes))
        strange = np.flatnonzero(~made & ~known)
        if len(strange):
            chars, of = np.unique(codes[strange], return_inverse=True)
            raw = [self.segment.bytes_of(chr(c).encode("utf-8", "surrogatepass")) for c in chars.tolist()]
            length = np.array([len(r) for r in raw], np.int64)
            starts[strange] = (len(ids) + np.cumsum(length) - length)[of]
            sizes[strange] = length[of]
            ids = np.concatenate([ids, *(np.array(r, np.int64) for r in raw)])
        return _gathered(ids, starts, sizes), np.bincount(words, sizes, minlength=int(words[-1]) + 1 if len(words) else 0).astype(np.int64)


class TextEncoder:
    """Ids of whole texts, an array at a time: distinct words are encoded once and remembered. Texts with user
    symbols or literal marks go to ``one``, which encodes a single text."""

    def __init__(self, join: Joiner, symbols: list, one):
        self.join, self.symbols, self.one = join, [*symbols, WORD_MARK], one
        self.forget()

    def forget(self) -> None:
        self.known: dict = {}
        self.pool = self.starts = self.lengths = np.zeros(0, np.int64)

    def places(self, words: list) -> np.ndarray:
        """The numbers of ``words`` among the remembered ones."""
        if len(self.known) > REMEMBERED_WORDS:
            self.forget()
        known = self.known
        fresh = [w for w in words if w not in known]
        if fresh:
            ids, lengths = self.join([WORD_MARK + w for w in fresh])
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.pool = np.concatenate([self.pool, ids])
            for w in fresh:
                known[w] = len(known)
        return np.array([known[w] for w in words], np.int64)

    def plain(self, texts: pa.Array) -> pa.Array:
        words = pc.split_pattern(texts, " ")
        rows = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
        found = words.flatten().dictionary_encode()
        at = self.places(found.dictionary.to_pylist())[found.indices.to_numpy()]
        lengths = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return pa.ListArray.from_arrays(pa.array(ends[rows].astype(np.int32)),
                                        pa.array(_gathered(self.pool, self.starts[at], lengths).astype(np.int32)))

    def __call__(self, texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("")
        other = pc.equal(texts, "")
        for s in self.symbols:
            other = pc.or_(other, pc.match_substring(texts, s))
        other = other.to_numpy(zero_copy_only=False)
        if not other.any():
            return self.plain(texts)
        alone = pa.array([self.one(t) for t in texts.filter(pa.array(other)).to_pylist()], pa.list_(pa.int32()))
        made = pa.concat_arrays([self.plain(texts.filter(pa.array(~other))), alone])
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([np.flatnonzero(~other), np.flatnonzero(other)])] = np.arange(len(texts))
        return made.take(pa.array(order))


class Cutter:
    """Cuts texts into user symbols, literal marks and words; ``words(text)`` gives ``(kind, string)``."""

    SYMBOL, MARK, WORD = range(3)

    def __init__(self, symbols: list, whole: bool):
        self.whole = whole  # pieces hold marks inside: the text between symbols is one word
        symbols = sorted(symbols, key=lambda s: (-len(s), s))
        self.parts = re.compile("(" + "|".join(map(re.escape, [*symbols, WORD_MARK])) + ")").split

    def __call__(self, text: str | None) -> Iterator[tuple[int, str]]:
        if not text:
            return
        begins = True
        for n, part in enumerate(self.parts(text)):
            if n % 2:
                if begins:
                    yield self.WORD, WORD_MARK
                yield (self.MARK if part == WORD_MARK else self.SYMBOL), part
            elif part:
                marked = (WORD_MARK if begins else "") + part.replace(" ", WORD_MARK)
                if self.whole:
                    yield self.WORD, marked
                else:
                    first, *rest = marked.split(WORD_MARK)
                    if first:
                        yield self.WORD, first
                    for word in rest:
                        yield self.WORD, WORD_MARK + word
            else:
                continue
            begins = False


class WordCutter(Cutter):
    """The cut of ``encode.PieceEncoder``: words between white space, which is lost; a part that begins its
    word carries the mark."""

    def __init__(self, symbols: list, whole: bool):
        symbols = sorted(symbols, key=lambda s: (-len(s), s))
        self.parts = re.compile("(" + "|".join(map(re.escape, symbols)) + ")").split if symbols else lambda t: [t]

    def __call__(self, text: str | None) -> Iterator[tuple[int, str]]:
        begins = True
        for n, part in enumerate(self.parts(text or "")):
            if n % 2:
                if begins:
                    yield self.WORD, WORD_MARK
                yield self.SYMBOL, part
                begins = False
                continue
            raw = part.encode()
            for k, word in enumerate(raw.split()):  # of bytes: at ASCII white space only
                yield self.WORD, (WORD_MARK if begins or k or raw[:1].isspace() else "") + word.decode()
            if raw:
                begins = begins and not raw.strip() or raw[-1:].isspace()


class Vocabulary:
    """Bounded facts of a vocabulary: its byte ids, user symbols, worst score, longest piece, and whether
    marks stand inside of pieces."""

    def __init__(self, vocab: DataFrame):
        normal, kind = F.col("kind") == "normal", F.col("kind")
        inside = normal & F.col("token").substr(F.lit(2), F.length("token")).contains(WORD_MARK)
        facts = vocab.agg(
            F.sum(F.octet_length("token") + ENTRY_BYTES).alias("bytes"), F.max(F.when(normal, F.length("token"))).alias("longest"),
            F.min(F.when(normal, F.col("score"))).alias("worst"), F.coalesce(F.bool_or(inside), F.lit(False)).alias("whole")).first()
        self.bytes, self.longest, self.worst = facts["bytes"] or 0, facts["longest"] or 1, facts["worst"] or 0.0
        self.whole = facts["whole"]
        small = vocab.filter(kind.isin("byte", "user_defined")).select("token", "id", "kind").collect()
        self.symbols = {r["token"]: r["id"] for r in small if r["kind"] == "user_defined"}
        by_byte = {r["token"]: r["id"] for r in small if r["kind"] == "byte"}
        wanted = [byte_piece(b) for b in range(256)]
        if by_byte and not by_byte.keys() >= set(wanted):
            raise ValueError("the vocabulary has some byte pieces, but not all 256")
        self.byte_ids = [by_byte[w] for w in wanted] if by_byte else None

    def segmenter(self, pieces: dict, unk_id: int, model_type: str) -> Segmenter:
        return Segmenter(pieces, self.byte_ids, unk_id, model_type, self.worst)


def _normal(vocab: DataFrame) -> DataFrame:
    return vocab.filter(F.col("kind") == "normal").select("token", "id", F.col("score").cast("double").alias("score"))


def text_ids(df: DataFrame, key: str, text_col: str, vocab: DataFrame, model_type: str = "bpe", unk_id: int = UNK_ID,
             max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """V6: ``(key, ids ARRAY<INT>)`` of every row, whole texts, nothing lost; null and empty texts give []."""
    if model_type not in ("bpe", "unigram"):
        raise ValueError(f"model_type must be bpe or unigram (got {model_type!r})")
    facts = Vocabulary(vocab)
    if facts.bytes > max_bytes:
        return joined_ids(df, key, text_col, vocab, model_type, unk_id, facts)
    table = _normal(vocab).toArrow()
    pieces = dict(zip(table.column("token").to_pylist(),
                      zip(table.column("id").to_pylist(), table.column("score").to_pylist(), strict=True), strict=True))
    shared = df.sparkSession.sparkContext.broadcast((facts, pieces))

    def make():
        facts, pieces = shared.value
        segment = facts.segmenter(pieces, unk_id, model_type)
        cut = Cutter(list(facts.symbols), facts.whole)
        remembered = segment if facts.whole else lru_cache(REMEMBERED_WORDS)(segment)
        literal = segment.bytes_of(MARK_BYTES)

        def ids(text: str | None) -> list:
            out: list = []
            for kind, part in cut(text):
                out += (remembered(part) if kind == cut.WORD else literal if kind == cut.MARK else [facts.symbols[part]])
            return out

        return TextEncoder(Joiner(pieces, segment), list(facts.symbols), ids) if together else ids

    together = model_type == "bpe" and not facts.whole
    return _map_column(df.select(key, text_col), text_col, "ids", "array<int>", pa.list_(pa.int32()), make, together).select(key, "ids")


def _piece_bits(vocab: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits as bytes, with the one at the hash of every normal piece set."""
    bit = _normal(vocab).select(F.crc32("token").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("bit"))
    rows = (bit.groupBy(F.shiftright("bit", 5).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, bit & 31)")).alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 32, "<u4")
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def _substrings(words: list, longest: int, bits: np.ndarray) -> list:
    """The distinct substrings of ``words``, up to ``longest`` characters, whose bits are set."""
    flags = memoryview(bits)
    found: set = set()

    @lru_cache(REMEMBERED_WORDS)
    def may_be(token: str) -> bool:
        h = zlib.crc32(token.encode("utf-8", "surrogatepass")) & (FILTER_BITS - 1)
        return bool(flags[h >> 3] >> (h & 7) & 1)

    for word in words:
        for i in range(len(word)):
            for j in range(i + 1, min(i + longest, len(word)) + 1):
                if may_be(word[i:j]):
                    found.add(word[i:j])
    return sorted(found)


def _bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _batch(raw: pa.Scalar) -> pa.RecordBatch:
    with pa.ipc.open_stream(raw.as_buffer()) as reader:
        return reader.read_next_batch()


def joined_ids(df: DataFrame, key: str, text_col: str, vocab: DataFrame, model_type: str = "bpe", unk_id: int = UNK_ID,
               facts: Vocabulary | None = None, cutter=Cutter) -> DataFrame:
    """``text_ids`` with the vocabulary as a table: equal to the broadcast form on any input."""
    ship_package(df.sparkSession)
    facts = facts or Vocabulary(vocab)
    shared = df.sparkSession.sparkContext.broadcast((facts, _piece_bits(vocab)))
    rows = df.select(F.col(key).alias("_row"), F.col(text_col).alias("_text"))
    row = rows.schema["_row"].dataType

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts, _ = shared.value
        cut = cutter(list(facts.symbols), facts.whole)
        for b in (part for whole in batches for part in slices(whole)):
            found = [list(cut(t)) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int32())),
                 pa.array([[w for _, w in f] for f in found], pa.list_(pa.string()))], ["_row", "kinds", "parts"])

    def chunk_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for some texts: their keys, the places of their parts among the distinct parts, those parts, and the
        substrings that may be pieces."""
        facts, bits = shared.value
        for b in (part for whole in batches for part in slices(whole)):
            parts = b.column("parts").flatten().dictionary_encode()
            codes = parts.indices.to_numpy().astype(np.int64) * 3 + b.column("kinds").flatten().to_numpy()
            distinct, at = np.unique(codes, return_inverse=True)
            kinds, texts = distinct % 3, parts.dictionary.take(pa.array(distinct // 3))
            lengths = pc.list_value_length(b.column("parts")).to_numpy(zero_copy_only=False)
            places = pa.ListArray.from_arrays(_offsets(lengths), pa.array(at.astype(np.int32)))
            words = texts.filter(pa.array(kinds == Cutter.WORD)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([_bytes(pa.RecordBatch.from_arrays([b.column("_row"), places], ["key", "at"]))], pa.binary()),
                 pa.array([_bytes(pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), texts], ["kind", "part"]))], pa.binary()),
                 pa.array([_substrings(words, facts.longest, bits)], pa.list_(pa.string()))], ["rows", "words", "tokens"])

    cut = rows.mapInArrow(cut_all, StructType().add("_row", row).add("kinds", INTS).add("parts", ArrayType(StringType())))
    # Chunks are numbered once; equal keys and texts stay rows of their own.
    chunks = materialize(cut.mapInArrow(chunk_all, "rows binary, words binary, tokens array<string>")
                         .select(F.monotonically_increasing_id().alias("_chunk"), "rows", "words", "tokens"))
    held = (chunks.select("_chunk", F.explode("tokens").alias("token")).join(_normal(vocab), "token").groupBy("_chunk")
            .agg(F.collect_list(F.struct("token", "id", "score")).alias("pieces")))
    asked = chunks.select("_chunk", "rows", "words").join(held, "_chunk", "left").select("rows", "words", "pieces")

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts, _ = shared.value
        for b in batches:
            for raw, words, pieces in zip(*(b.column(c) for c in ("rows", "words", "pieces")), strict=True):
                segment = facts.segmenter({p["token"]: (p["id"], p["score"]) for p in pieces.as_py() or ()}, unk_id, model_type)
                made = [(facts.symbols[part],) if kind == Cutter.SYMBOL else segment.bytes_of(MARK_BYTES)
                        if kind == Cutter.MARK else segment(part)
                        for kind, part in zip(*(_batch(words).column(c).to_pylist() for c in ("kind", "part")), strict=True)]
                texts = _batch(raw)
                yield pa.RecordBatch.from_arrays([texts.column("key"), _taken(pa.array(made, pa.list_(pa.int32())), texts.column("at"))],
                                                 ["_key", "ids"])

    encoded = asked.mapInArrow(encode_all, StructType().add("_key", row).add("ids", INTS))
    return encoded.select(F.col("_key").alias(key), "ids")


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def _taken(values: pa.ListArray, places: pa.ListArray) -> pa.ListArray:
    """For each list of ``places`` the lists of ``values`` there, one behind the other."""
    parts = values.take(places.flatten())
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
    rows = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends[rows].astype(np.int32)), parts.flatten())


class Decoder:
    """Text of a list of ids; bytes of adjacent byte pieces are joined, each byte that is part of no
    whole character gives U+FFFD; special pieces and unknown ids give nothing."""

    def __init__(self, rows: list):
        self.bytes = {i: int(t[3:5], 16) for t, i, k in rows if k == "byte"}
        self.pieces = {i: (t if k == "user_defined" else t.replace(WORD_MARK, " ")) for t, i, k in rows
                       if k in ("normal", "user_defined")}
        self.marked = {i for t, i, k in rows if k == "normal" and t.startswith(WORD_MARK)}

    def __call__(self, ids) -> str:
        out: list = []
        run = bytearray()
        first = None
        for i in ids or ():
            if i in self.bytes:
                first = i if first is None else first
                run.append(self.bytes[i])
                continue
            piece = self.pieces.get(i)
            if piece is None:
                continue
            first = i if first is None else first
            if run:
                out.append(whole_characters(bytes(run)))
                run.clear()
            out.append(piece)
        if run:
            out.append(whole_characters(bytes(run)))
        text = "".join(out)
        return text[1:] if first in self.marked else text


class TextDecoder:
    """``Decoder`` of an array of lists at a time: the bytes of all pieces in a row. Lists whose bytes are not
    whole characters go to ``Decoder`` one by one."""

    def __init__(self, rows: list):
        self.one = Decoder(rows)
        given = {i: bytes([b]) for i, b in self.one.bytes.items()} | {
            i: p.encode("utf-8", "surrogatepass") for i, p in self.one.pieces.items() if i not in self.one.bytes}
        self.ids = np.array(sorted(given), np.int64)
        self.raw = pa.array([*(given[i] for i in self.ids.tolist()), b""], pa.binary())
        self.marked = np.array([i in self.one.marked and i not in self.one.bytes for i in self.ids.tolist()] + [False])
        self.exact = all(given.values())  # an empty piece would end a run of bytes

    def __call__(self, lists: pa.Array) -> pa.Array:
        rows = np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))]).astype(np.int64)
        flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(self.ids, flat)
        at[np.append(self.ids, -1)[at] != flat] = len(self.ids)
        taken = self.raw.take(pa.array(at))
        sizes = pc.binary_length(taken).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = b"".join(taken.to_pylist()) if len(taken) < 64 else taken.buffers()[2].to_pybytes()[:ends[-1]]
        starts, ends = ends[rows[:-1]], ends[rows[1:]]
        # The first id that gives anything may be a piece with a mark, whose space goes.
        given = np.append(at, len(self.ids)) < len(self.ids)
        first = np.append(np.flatnonzero(given), len(at))[np.concatenate([[0], np.cumsum(given)])[rows[:-1]]]
        marked = (first < rows[1:]) & self.marked[np.append(at, len(self.ids))[first]]
        texts = []
        for i, (a, b, m) in enumerate(zip(starts.tolist(), ends.tolist(), marked.tolist(), strict=True)):
            try:
                if not self.exact:
                    raise UnicodeDecodeError("utf-8", b"", 0, 0, "pieces without text")
                text = data[a:b].decode()
                texts.append(text[1:] if m else text)
            except UnicodeDecodeError:
                texts.append(self.one(lists[i].as_py()))
        return pa.array(texts, pa.string())


def whole_characters(raw: bytes) -> str:
    """UTF-8 text; every byte that belongs to no whole character is one U+FFFD."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out += [raw[:e.start].decode(), "�"]
            raw = raw[e.start + 1:]
    return "".join(out)


def decode_texts(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """V7: ``(key, text)`` of every row, the inverse of ``text_ids``; null and empty lists give ''.

    A vocabulary beyond the bound is joined by id, and the pieces go to their rows again."""
    facts = Vocabulary(vocab)
    columns = vocab.select("token", "id", "kind")
    if facts.bytes <= max_bytes:
        rows = [tuple(r) for r in columns.collect()]
        shared = df.sparkSession.sparkContext.broadcast(rows)
        return _map_column(df.select(key, ids_col), ids_col, "text", "string", pa.string(),
                           lambda: TextDecoder(shared.value), True).select(key, "text")
    ship_package(df.sparkSession)
    rows = materialize(df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
                                 F.col(ids_col).alias("_ids")), how="table")
    held = (rows.select("_row", F.explode(F.array_distinct("_ids")).alias("id")).join(columns, "id").groupBy("_row")
            .agg(F.collect_list(F.struct("token", "id", "kind")).alias("pieces")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole)):
            texts = [Decoder([(p["token"], p["id"], p["kind"]) for p in pieces or ()])(ids)
                     for ids, pieces in zip(b.column("_ids").to_pylist(), b.column("pieces").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array(texts, pa.string())], ["_key", "text"])

    kind = df.schema[key].dataType.simpleString()
    joined = rows.join(held, "_row", "left").select("_key", "_ids", "pieces")
    return joined.mapInArrow(run, f"_key {kind}, text string").select(F.col("_key").alias(key), "text")
