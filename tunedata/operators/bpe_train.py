"""BPE merges at production size (V1, A10, O5): many exact merges a round.

A round takes the ``k`` best pairs and cuts each word into *runs*: the longest parts in which every
two neighbours are one of those pairs. Equal runs are summed up by Spark, and the driver, which gets
at most ``max_segments`` of them, merges greedily inside of them:

* the other pairs rank behind the last of the ``k`` and never gain. What a merge makes of two
  neighbours is at most as frequent as they are, so the round goes on until nothing ranks before
  that last pair, and no merge in it crosses from one run to another;
* every occurrence of the ``k`` pairs is in a run, and new pairs come from merges only, so the
  counts are exact but for pairs across the ends of runs, which are too rare to be taken (``greedy``
  has the rule for those as frequent as the last of the ``k``).

The merges found are exactly those of one-at-a-time greedy merging, hundreds to thousands a round.
They are applied to the words by the tasks, which write the words anew, so a lost executor costs
one round. The words are *blocks*: a row has some ten thousand of them as numbers, one behind the
other. A symbol's number is its code point, or ``FIRST_MADE`` and its place among the products.
``k`` follows the number of runs.

``pair_counts``, ``segments_of`` and ``merged`` do the same to a table of words as text.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.session import materialize, ship_package

# Pairs that a round looks at, from careful to bold.
LADDER = tuple((1 << i,) for i in range(18))
FIRST_STEP = 6
OPEN_LEFT, OPEN_RIGHT = 1, 2
# Words that a task takes as arrays at a time, and distinct pairs that it holds before they go on.
BATCH_WORDS, HELD_PAIRS = 1 << 15, 1 << 21
# Distinct runs that a task holds before they go on.
HELD_RUNS = 1 << 17
# Numbers below are code points, numbers from here on products of merges.
FIRST_MADE = 0x110000
BLOCK = "symbols bigint, words bigint, codes binary, lengths binary, counts binary"


class Words:
    """Runs of symbols, with the runs that hold each pair."""

    def __init__(self):
        self.text: list = []
        self.number: dict = {}
        self.words: list = []
        self.counts: list = []
        self.open: list = []
        self.index: dict = defaultdict(list)

    def symbol(self, text: str) -> int:
        at = self.number.get(text)
        if at is None:
            at = self.number[text] = len(self.text)
            self.text.append(text)
        return at

    def add(self, symbols: list, n: int, ends: int = 0) -> None:
        word = [self.symbol(s) for s in symbols]
        for pair in set(zip(word, word[1:])):
            self.index[pair].append(len(self.words))
        self.words.append(word)
        self.counts.append(n)
        self.open.append(ends)

    def merge(self, a: str, b: str) -> tuple[dict, int, int]:
        """Merges ``(a, b)`` left to right in the runs that hold it. Gives the differences of pair counts,
        and how many of the new symbols stand at an open left and at an open right end."""
        change: dict = defaultdict(int)
        left = right = 0
        if a not in self.number or b not in self.number:
            return change, left, right
        x, y = self.number[a], self.number[b]
        new = self.symbol(a + b)
        for i in self.index.pop((x, y), ()):
            old, n = self.words[i], self.counts[i]
            word, k, last = [], 0, len(old) - 1
            while k <= last:
                if k < last and old[k] == x and old[k + 1] == y:
                    word.append(new)
                    k += 2
                else:
                    word.append(old[k])
                    k += 1
            if len(word) == len(old):  # named by the index, but an earlier merge took the pair
                continue
            self.words[i] = word
            if word[0] == new and self.open[i] & OPEN_LEFT:
                left += n
            if word[-1] == new and self.open[i] & OPEN_RIGHT:
                right += n
            before = set()
            for pair in zip(old, old[1:]):
                change[pair] -= n
                before.add(pair)
            for pair in zip(word, word[1:]):
                change[pair] += n
                if pair not in before:
                    before.add(pair)
                    self.index[pair].append(i)
        return change, left, right


class Ranking:
    """Counts of pairs, best first; the heap may hold outdated entries."""

    def __init__(self):
        self.counts: dict = {}
        self.heap: list = []

    def add(self, a: str, b: str, n: int) -> None:
        total = self.counts.get((a, b), 0) + n
        if total:
            self.counts[a, b] = total
            heapq.heappush(self.heap, (-total, a, b))
        else:
            self.counts.pop((a, b), None)

    def best(self) -> tuple | None:
        while self.heap:
            entry = self.heap[0]
            if self.counts.get(entry[1:]) == -entry[0]:
                return entry
            heapq.heappop(self.heap)
        return None


def greedy(top: list, complete: bool, segments: list, products: set, remaining: int) -> list:
    """The next merges ``(a, b, n)`` of one-at-a-time greedy merging, as many as are certain.

    ``top`` are the best pairs ``(a, b, n)``, ranked, all there are if ``complete``; ``segments`` are
    ``(symbols, n, open ends)``. ``products`` are the symbols that earlier merges made: a merge that
    makes one of them again is the last, since its pairs add to ones that are not seen here.

    A pair that is not seen stands where a pair behind ``top`` stood, and has its count at most. With
    the count of the last of ``top`` it ranks behind that one too, unless its first symbol was made
    here and had as many occurrences at open right ends.
    """
    ranking, runs = Ranking(), Words()
    for a, b, n in top:
        ranking.add(a, b, n)
    for symbols, n, ends in segments:
        runs.add(symbols, n, ends)
    shown = {(a, b) for a, b, _ in top}
    made: set = set()
    taken: list = []
    last = (-top[-1][2], top[-1][0], top[-1][1])
    hidden = None  # the least symbol that may begin such a pair
    while len(taken) < remaining:
        entry = ranking.best()
        if entry is None or not complete and entry > last:
            break
        n, a, b = -entry[0], *entry[1:]
        if n == -last[0] and hidden is not None and a >= hidden:
            break
        taken.append((a, b, n))
        change, _, right = runs.merge(a, b)
        new = a + b
        if new in products or new in made:
            break
        made.add(new)
        known = 0
        for (x, y), d in change.items():
            p, q = runs.text[x], runs.text[y]
            if d and ((p, q) in shown or p in made or q in made):
                ranking.add(p, q, d)
            known = max(known, d) if p == new else known
        ranking.counts.pop((a, b), None)
        if not complete and right and right + known >= -last[0]:
            hidden = new if hidden is None else min(hidden, new)
    return taken


class Batch:
    """Words (``sym, n``) as arrays: ``codes`` number their symbols in ``names``, one word behind the other."""

    def __init__(self, batch: pa.RecordBatch):
        lists = pc.split_pattern(batch.column("sym"), " ")
        flat = lists.flatten().dictionary_encode()
        self.names, self.codes = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
        self.lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
        self.counts = batch.column("n").to_numpy()
        self.number = {name: i for i, name in enumerate(self.names.to_pylist())}

    def numbers(self, names: list) -> np.ndarray:
        """Numbers of ``names``; those that no word has are added."""
        fresh = len(self.number)
        found = np.array([self.number.setdefault(name, len(self.number)) for name in names], np.int64)
        if len(self.number) > fresh:
            self.names = pa.concat_arrays([self.names, pa.array(list(self.number)[fresh:], pa.string())])
        return found


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of some ten thousand words, whatever the size of those that come."""
    held: list = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= BATCH_WORDS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _pair_keys(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every position's pair with the next one as a number (-1 at the end of a word), and its word."""
    keys = np.full(len(codes), -1, np.int64)
    keys[:-1] = codes[:-1] << 32 | codes[1:]
    keys[np.cumsum(lengths) - 1] = -1
    return keys, np.repeat(np.arange(len(lengths)), lengths)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` and the sums of their ``counts``."""
    order = np.argsort(keys, kind="stable")
    keys, at = np.unique(keys[order], return_index=True)
    return keys, np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def pair_counts(words: DataFrame) -> DataFrame:
    """``a, b, n``: adjacent pairs of the symbols of ``words`` (``sym, n``) with their counts, as
    ``vocab.pair_counts``; a task sums up its words before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict = {}
        held: list = []

        def rows(sums: tuple) -> pa.RecordBatch:
            text, (keys, n) = pa.array(list(names), pa.string()), sums
            return pa.RecordBatch.from_arrays([text.take(pa.array(keys >> 32)), text.take(pa.array(keys & 0xFFFFFFFF)), pa.array(n)],
                                              ["a", "b", "n"])

        def total() -> tuple:
            return _summed(*(np.concatenate(part) for part in zip(*held, strict=True)))

        for b in _batches(batches):
            words = Batch(b)
            to = np.array([names.setdefault(name, len(names)) for name in words.number], np.int64)
            keys, word = _pair_keys(to[words.codes], words.lengths)
            inside = keys >= 0
            held.append(_summed(keys[inside], words.counts[word[inside]]))
            if sum(len(keys) for keys, _ in held) >= HELD_PAIRS:
                held = [total()]
                if len(held[0][0]) >= HELD_PAIRS // 2:
                    yield rows(held.pop())
        if held:
            yield rows(total())

    return words.mapInArrow(run, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def segments_of(words: DataFrame, pairs: list, reach: int) -> DataFrame:
    """``sym, ends, n``: the segments of ``words`` (``sym, n``) around the occurrences of ``pairs``."""
    shared = words.sparkSession.sparkContext.broadcast(list(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            words = Batch(b)
            first, second = (words.numbers([pair[i] for pair in shared.value]) for i in range(2))
            keys, word = _pair_keys(words.codes, words.lengths)
            hits = np.flatnonzero(np.isin(keys, first << 32 | second))
            start = _starts(words.lengths)
            end = start + words.lengths
            # Ends that touch make one segment.
            borders = np.zeros(len(keys) + 1, np.int64)
            np.add.at(borders, np.maximum(start[word[hits]], hits - reach), 1)
            np.add.at(borders, np.minimum(end[word[hits]], hits + 2 + reach), -1)
            near = np.cumsum(borders[:-1]) > 0
            begins, ends = near.copy(), near.copy()
            begins[1:] &= ~near[:-1] | (word[1:] != word[:-1])
            ends[:-1] &= ~near[1:] | (word[1:] != word[:-1])
            begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            of = word[begins]
            opens = OPEN_LEFT * (begins > start[of]) + OPEN_RIGHT * (ends < end[of])
            made = pa.table({"sym": _texts(words.names, words.codes[near], ends - begins), "ends": pa.array(opens, pa.int32()),
                             "n": pa.array(words.counts[of], pa.int64())})
            made = made.group_by(["sym", "ends"], use_threads=False).aggregate([("n", "sum")])
            yield from made.select(["sym", "ends", "n_sum"]).rename_columns(["sym", "ends", "n"]).combine_chunks().to_batches()

    return words.mapInArrow(run, "sym string, ends int, n bigint").groupBy("sym", "ends").agg(F.sum("n").alias("n"))


def _texts(names: pa.Array, codes: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of symbols as text, with spaces between the symbols."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(codes))), " ")


def merged(words: DataFrame, merges: list) -> DataFrame:
    """``words`` (``sym, n``) after ``merges`` (pairs, in order); words of one symbol are left out."""
    shared = words.sparkSession.sparkContext.broadcast(list(merges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            words, merges = Batch(b), shared.value
            first, second = (words.numbers([pair[i] for pair in merges]) for i in range(2))
            product = words.numbers([x + y for x, y in merges])
            table = first << 32 | second
            order = np.argsort(table)
            table = table[order]
            codes, lengths, counts = words.codes, words.lengths, words.counts
            none = len(table)
            untouched = True
            while len(lengths):
                keys, word = _pair_keys(codes, lengths)
                at = np.minimum(np.searchsorted(table, keys), none - 1)
                rank = np.where(table[at] == keys, order[at], none)
                least = np.minimum.reduceat(rank, _starts(lengths))
                done = least == none
                kept = done & (lengths > 1)
                if kept.any():
                    # Words that hold no merge at all stay as they are.
                    sym = (b.column("sym").filter(pa.array(kept)) if untouched
                           else _texts(words.names, codes[kept[word]], lengths[kept]))
                    yield pa.RecordBatch.from_arrays([sym, pa.array(counts[kept], pa.int64())], ["sym", "n"])
                # The first merge of each other word, at all of its places from left to right.
                open_ = ~done[word]
                rank, least, codes = rank[open_], least[~done], codes[open_]
                lengths, counts = lengths[~done], counts[~done]
                word = np.repeat(np.arange(len(lengths)), lengths)
                hits = np.flatnonzero(rank == least[word])
                if len(hits):
                    fresh = np.concatenate([[True], np.diff(hits) != 1])
                    runs = np.flatnonzero(fresh)
                    hits = hits[(np.arange(len(hits)) - runs[np.cumsum(fresh) - 1]) % 2 == 0]
                    codes[hits] = product[rank[hits]]
                    codes = np.delete(codes, hits + 1)
                    lengths = lengths - np.bincount(word[hits], minlength=len(lengths))
                untouched = False

    return words.mapInArrow(run, "sym string, n bigint")


class Block:
    """Words as arrays: the numbers of their symbols, one word behind the other, their lengths and counts."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, counts: np.ndarray):
        self.codes, self.lengths, self.counts = codes, lengths, counts

    @classmethod
    def of_words(cls, batch: pa.RecordBatch) -> Block:
        """Of words (``sym, n``) whose symbols are characters."""
        text = np.frombuffer(" ".join(batch.column("sym").to_pylist()).encode("utf-32-le"), np.uint32)
        lengths = (pc.utf8_length(batch.column("sym")).to_numpy().astype(np.int64) + 1) // 2
        codes = text[::2].astype(np.int64)
        if len(codes) != lengths.sum() or (text[1::2] != ord(" ")).any():
            raise ValueError("the symbols of the words to start with must be characters")
        return cls(codes, lengths, batch.column("n").to_numpy().astype(np.int64))

    @classmethod
    def blocks(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for b in batches:
            for symbols, words, codes, lengths, counts in zip(*(b.column(i) for i in range(5)), strict=True):
                shapes = ((codes, np.uint32, symbols), (lengths, np.uint32, words), (counts, np.int64, words))
                yield cls(*(np.frombuffer(pa.decompress(v.as_buffer(), n.as_py() * np.dtype(t).itemsize, "lz4"), t).astype(np.int64)
                            for v, t, n in shapes))

    def row(self) -> pa.RecordBatch:
        arrays = (self.codes.astype(np.uint32), self.lengths.astype(np.uint32), self.counts.astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(self.codes)], pa.int64()), pa.array([len(self.lengths)], pa.int64()),
             *(pa.array([pa.compress(a.tobytes(), "lz4", asbytes=True)], pa.binary()) for a in arrays)],
            ["symbols", "words", "codes", "lengths", "counts"])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        return _pair_keys(self.codes, self.lengths)


class Pairs:
    """Finds the places of ranked pairs, given as numbers ``first << 32 | second``."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self._hash(keys)] = True

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``keys`` that hold a pair, and the pairs' ranks."""
        places = np.flatnonzero(self.seen[self._hash(keys)])
        if not len(self.keys) or not len(places):
            return places[:0], places[:0]
        wanted = keys[places]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        right = self.keys[at] == wanted
        return places[right], self.order[at[right]]


class Names:
    """Symbols by their numbers, and their places among all symbols in order of their text."""

    def __init__(self):
        self.made: list = []
        self.number: dict = {}

    def add(self, text: str) -> None:
        if text not in self.number:
            self.number[text] = FIRST_MADE + len(self.made)
            self.made.append(text)

    def code(self, text: str) -> int:
        return ord(text) if len(text) == 1 else self.number[text]

    def text(self, code: int) -> str:
        return chr(code) if code < FIRST_MADE else self.made[code - FIRST_MADE]

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """The products' first characters in order of the products, and each product's place in that order."""
        by_text = sorted(range(len(self.made)), key=self.made.__getitem__)
        place = np.empty(len(by_text), np.int64)
        place[by_text] = np.arange(len(by_text))
        return np.array([ord(self.made[i][0]) for i in by_text], np.int64), place

    @staticmethod
    def ranks(codes: np.ndarray, order: tuple) -> np.ndarray:
        """Numbers in the symbols' order; a product follows the characters up to its first one."""
        firsts, place = order
        out = codes + np.searchsorted(firsts, codes)
        is_made = codes >= FIRST_MADE
        at = place[codes[is_made] - FIRST_MADE]
        out[is_made] = firsts[at] + 1 + at
        return out

    def of_ranks(self, ranks: np.ndarray, order: tuple) -> list:
        """The texts of such numbers."""
        firsts, place = order
        taken = firsts + 1 + np.arange(len(firsts))
        by_place = np.argsort(place)
        at = np.searchsorted(taken, ranks)
        is_made = np.append(taken, -1)[at] == ranks
        return [self.made[by_place[i]] if m else chr(r - i) for r, i, m in zip(ranks.tolist(), at.tolist(), is_made.tolist(), strict=True)]


def packed(words: DataFrame) -> DataFrame:
    """The blocks of words (``sym, n``) whose symbols are characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            yield Block.of_words(b).row()

    return words.mapInArrow(run, BLOCK)


def best_pairs(blocks: DataFrame, names: Names, k: int) -> list:
    """The ``k`` best pairs ``(a, b, n)`` of ``blocks``, best first, ties to the smaller ``(a, b)``; a task sums
    up its words before the shuffle."""
    order = names.order()
    shared = blocks.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            a, b = (Names.ranks(x, shared.value) for x in (keys >> 32, keys & 0xFFFFFFFF))
            return pa.RecordBatch.from_arrays([pa.array(a << 32 | b), pa.array(n)], ["pair", "n"])

        for block in Block.blocks(batches):
            keys, word = block.pairs()
            inside = keys >= 0
            held.append(_summed(keys[inside], block.counts[word[inside]]))
            if sum(len(keys) for keys, _ in held) >= HELD_PAIRS:
                held = [_summed(*(np.concatenate(part) for part in zip(*held, strict=True)))]
                if len(held[0][0]) >= HELD_PAIRS // 2:
                    yield rows(*held.pop())
        if held:
            yield rows(*_summed(*(np.concatenate(part) for part in zip(*held, strict=True))))

    summed = blocks.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    best = summed.orderBy(F.desc("n"), "pair").limit(k).toArrow()
    pair = best.column("pair").to_numpy()
    return list(zip(names.of_ranks(pair >> 32, order), names.of_ranks(pair & 0xFFFFFFFF, order), best.column("n").to_pylist(), strict=True))


def _keys(names: Names, pairs: list) -> np.ndarray:
    return np.array([names.code(a) << 32 | names.code(b) for a, b in pairs], np.int64)


def runs_of(blocks: DataFrame, names: Names, pairs: list) -> DataFrame:
    """``codes, ends, n``: the runs of ``blocks`` in which all neighbours are ``pairs``, their symbols' numbers
    as 4 bytes each."""
    shared = blocks.sparkSession.sparkContext.broadcast(_keys(names, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(shared.value)
        held: list = []

        def total() -> pa.Table:
            t = pa.concat_tables(held).group_by(["codes", "ends"], use_threads=False).aggregate([("n", "sum")])
            return t.select(["codes", "ends", "n_sum"]).rename_columns(["codes", "ends", "n"])

        for block in Block.blocks(batches):
            keys, word = block.pairs()
            hits, _ = pairs.find(keys)
            if not len(hits):
                continue
            after = np.diff(hits) != 1  # a pair that is one leads on to the next place of its own word
            begins, ends = hits[np.append(True, after)], hits[np.append(after, True)] + 2
            near = np.zeros(len(keys), bool)
            near[hits] = near[hits + 1] = True
            of = word[begins]
            start = _starts(block.lengths)[of]
            opens = OPEN_LEFT * (begins > start) + OPEN_RIGHT * (ends < start + block.lengths[of])
            offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32) * 4
            codes = pa.Array.from_buffers(pa.binary(), len(begins),
                                          [None, pa.py_buffer(offsets), pa.py_buffer(block.codes[near].astype(np.uint32))])
            made = pa.table({"codes": codes, "ends": pa.array(opens, pa.int32()), "n": pa.array(block.counts[of], pa.int64())})
            held.append(made.group_by(["codes", "ends"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["codes", "ends", "n"]))
            if sum(len(t) for t in held) >= HELD_RUNS:
                held = [total()]
                if len(held[0]) >= HELD_RUNS // 2:
                    yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from total().combine_chunks().to_batches()

    return blocks.mapInArrow(run, "codes binary, ends int, n bigint").groupBy("codes", "ends").agg(F.sum("n").alias("n"))


def after_merges(blocks: DataFrame, names: Names, merges: list) -> DataFrame:
    """``blocks`` after ``merges`` (pairs, in order); words of one symbol are left out."""
    shared = blocks.sparkSession.sparkContext.broadcast(
        (_keys(names, merges), np.array([names.code(a + b) for a, b in merges], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, product = Pairs(shared.value[0]), shared.value[1]
        none = len(product)
        for block in Block.blocks(batches):
            codes, lengths, counts = block.codes, block.lengths, block.counts
            done: list = []
            while len(lengths):
                keys, word = _pair_keys(codes, lengths)
                places, ranks = pairs.find(keys)
                least = np.full(len(lengths), none, np.int64)
                np.minimum.at(least, word[places], ranks)
                open_ = least < none
                kept = ~open_ & (lengths > 1)
                done.append((codes[kept[word]], lengths[kept], counts[kept]))
                # The first merge of each other word, at all of its places from left to right.
                rank = np.full(len(keys), none, np.int64)
                rank[places] = ranks
                inside = open_[word]
                rank, codes = rank[inside], codes[inside]
                least, lengths, counts = least[open_], lengths[open_], counts[open_]
                word = np.repeat(np.arange(len(lengths)), lengths)
                hits = np.flatnonzero(rank == least[word])
                if len(hits):
                    fresh = np.concatenate([[True], np.diff(hits) != 1])
                    runs = np.flatnonzero(fresh)
                    hits = hits[(np.arange(len(hits)) - runs[np.cumsum(fresh) - 1]) % 2 == 0]
                    codes[hits] = product[rank[hits]]
                    left = np.ones(len(codes), bool)
                    left[hits + 1] = False
                    codes = codes[left]
                    lengths = lengths - np.bincount(word[hits], minlength=len(lengths))
            now = Block(*(np.concatenate(part) for part in zip(*done, strict=True))) if done else None
            if now and len(now.lengths):
                yield now.row()

    return blocks.mapInArrow(run, BLOCK)


def train(words: DataFrame, n_merges: int, max_segments: int = 200_000, ladder=LADDER) -> list:
    """Greedy merges ``(rank, a, b, n)``, ties to the smaller ``(a, b)``, of ``words`` (``sym, n``: characters
    between spaces)."""
    ship_package(words.sparkSession)
    blocks = materialize(packed(words))
    names, merges = Names(), []
    products: set = set()
    step = min(FIRST_STEP, len(ladder) - 1)
    while len(merges) < n_merges:
        ranked = best_pairs(blocks, names, ladder[step][0] + 1)
        if not ranked:
            break
        while True:
            k = ladder[step][0]
            top, complete = ranked[:k], len(ranked) <= k
            rows = runs_of(blocks, names, [(a, b) for a, b, _ in top]).limit(max_segments + 1).toArrow()
            if len(rows) <= max_segments:
                runs = [([names.text(c) for c in np.frombuffer(codes, np.uint32).tolist()], n, ends)
                        for codes, ends, n in zip(*(rows.column(c).to_pylist() for c in ("codes", "ends", "n")), strict=True)]
                found = greedy(top, complete, runs, products, n_merges - len(merges))
                break
            if step == 0:
                found = top[:1]  # the best pair alone needs no runs
                break
            step -= 1
        if len(rows) < max_segments // 3 and step + 1 < len(ladder):
            step += 1
        for a, b, n in found:
            merges.append((len(merges), a, b, n))
            products.add(a + b)
            names.add(a + b)
        if len(merges) < n_merges:
            blocks = materialize(after_merges(blocks, names, [(a, b) for a, b, _ in found]))
    return merges
