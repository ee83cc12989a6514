"""Ranked lexical search by multi-query common-subexpression evaluation.

The items' term sets are mined for shared pairs: the pair of symbols held by
most items becomes a node of its own, the items hold the node instead of the
pair, and so on until no pair is shared. The nodes form a DAG: every node adds
two earlier ones, every item adds what is left of it. A document's accumulator
of a node is made once and used by all nodes and items above it; documents are
taken a batch at a time, so a node's accumulators are one integer column.

Plan: one pass over the texts writes a thin table (id, number of terms, which of
the searched terms how often) and yields the corpus counts by map-side sums;
a second pass over that table scores it. A task keeps ``k`` rows an item, and the
rows of one item are merged in two levels, so no task gets all of them. Items are
searched in blocks of bounded size (``block_items`` items, ``block_terms`` distinct
terms), so what is broadcast does not grow with the items or the documents.

Defined cases: null and empty texts have no terms and are no part of the counts;
an item without terms, or without a document above score 0, gives no rows; equal
rows are separate documents, and rows of equal score go by id, null ids last;
a null item id is an item of its own and equal item rows give their rows each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready, text_or_empty
from tunedata.session import materialize

# A term's bytes: 0-9, A-Z (lower-cased), a-z and all of UTF-8 above ASCII; any other byte ends it.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
# Splits of an item's rows in the first level of the merge.
MERGE_SPLITS = 64


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class SharedTerms:
    """DAG of the term sets shared by ``items`` (lists of distinct symbols ``0 .. n_terms - 1``).

    ``nodes[j]`` is the pair of symbols that symbol ``n_terms + j`` adds;
    ``rest[i]`` the symbols that make up item ``i``. Terms of exactly the same items are
    added up first, so that long items in common are no matter of pairs. Where more than
    ``MAX_PAIRS`` pairs are left, an item's ``MINED`` most shared symbols are paired; this
    shares less and changes no sum.
    """

    MAX_PAIRS, MINED = 2_000_000, 64

    def __init__(self, items: list, n_terms: int):
        self.n_terms, self.nodes = n_terms, []
        held = [set(x) for x in items]
        self._add_up_twins(held)
        count = Counter(x for symbols in held for x in symbols)
        mined = [sorted((x for x in symbols if count[x] > 1), key=lambda x: (-count[x], x)) for symbols in held]
        if sum(len(m) ** 2 // 2 for m in mined) > self.MAX_PAIRS:
            mined = [m[:self.MINED] for m in mined]
        holders: dict = {}
        for i, symbols in enumerate(mined):
            for pair in combinations(sorted(symbols), 2):
                holders.setdefault(pair, set()).add(i)
        heap = [(-len(h), p) for p, h in holders.items() if len(h) > 1]
        heapq.heapify(heap)
        while heap:
            n, pair = heapq.heappop(heap)
            now = holders.get(pair, ())
            if len(now) < 2:
                continue
            if len(now) != -n:  # an earlier node took one of its symbols from some items
                heapq.heappush(heap, (-len(now), pair))
                continue
            a, b = pair
            new = self._node(a, b)
            grown: dict = {}
            for i in list(now):
                held[i] -= {a, b}
                for x in held[i]:
                    # Only pairs that were shared with the old symbols can be shared with their sum.
                    both = [holders.get((min(x, old), max(x, old)), ()) for old in (a, b)]
                    if all(i in h for h in both):
                        grown.setdefault((x, new), set()).add(i)
                    for h in both:
                        if i in h:
                            h.discard(i)
                held[i].add(new)
            del holders[pair]
            for p, h in grown.items():
                if len(h) > 1:
                    holders[p] = h
                    heapq.heappush(heap, (-len(h), p))
        self.rest = [np.array(sorted(x), np.int64) for x in held]

    def _node(self, a: int, b: int) -> int:
        self.nodes.append((a, b))
        return self.n_terms + len(self.nodes) - 1

    def _add_up_twins(self, held: list) -> None:
        holders: dict = {}
        for i, symbols in enumerate(held):
            for x in symbols:
                holders.setdefault(x, []).append(i)
        twins: dict = {}
        for x, h in sorted(holders.items()):
            if len(h) > 1:
                twins.setdefault(tuple(h), []).append(x)
        for h, symbols in twins.items():
            total = symbols[0]
            for x in symbols[1:]:
                total = self._node(total, x)
            for i in h:
                held[i] -= set(symbols)
                held[i].add(total)

    def additions(self) -> int:
        return len(self.nodes) + sum(max(0, len(r) - 1) for r in self.rest)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Items' sums (rows) for documents (columns), from the terms' values (rows)."""
        acc = np.empty((self.n_terms + len(self.nodes), terms.shape[1]), np.int64)
        acc[:self.n_terms] = terms
        for j, (a, b) in enumerate(self.nodes, self.n_terms):
            np.add(acc[a], acc[b], out=acc[j])
        return np.stack([acc[r].sum(0) for r in self.rest]) if self.rest else acc[:0]


def forward_index(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, term, tf`` of every row of ``docs`` with a term: its number of terms, and which
    words of the broadcast ``vocabulary`` (word to number) it holds how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for b in batches:
            at, ns, held, tfs = [], [], [], []
            for i, text in enumerate(b.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                found = np.fromiter(map(number, words, repeat(-1)), np.int64, len(words))
                which, tf = np.unique(found[found >= 0], return_counts=True)
                at.append(i)
                ns.append(len(words))
                held.append(which.astype(np.int32))
                tfs.append(tf.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ns, pa.int64()),
                 pa.array(held, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["doc_id", "n", "term", "tf"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n bigint, term array<int>, tf array<bigint>")


class TopK:
    """The ``k`` best rows (score, then place in ``ids`` order) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list = [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)

    def add(self, scores: np.ndarray, ids: list) -> None:
        for i in np.flatnonzero((scores >= np.maximum(self.least, 1)[:, None]).any(1)).tolist():
            hit = np.flatnonzero(scores[i] >= max(self.least[i], 1))
            new = [(-int(scores[i, d]), ids[d] is None, ids[d] if ids[d] is not None else 0) for d in hit.tolist()]
            self.rows[i] = heapq.nsmallest(self.k, self.rows[i] + new)
            if len(self.rows[i]) == self.k:
                self.least[i] = -self.rows[i][-1][0]


def partial_best(index: DataFrame, plan, id_kind: str, k: int) -> DataFrame:
    """``item, doc_id, score``: each task's ``k`` best documents of each item. ``plan`` is a broadcast
    (SharedTerms, weight of each term, N, L)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, weights, n_docs, n_all = plan.value
        best = TopK(len(shared.rest), k)
        for b in batches:
            n = b.column("n").to_numpy()
            held, tf = b.column("term"), b.column("tf")
            which, tf = held.flatten().to_numpy(), tf.flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), np.diff(held.offsets.to_numpy()))
            m = 10 + 90 * n * n_docs // n_all
            values = np.zeros((shared.n_terms, len(n)), np.int64)
            values[which, doc] = weights[which] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            best.add(shared.scores(values), b.column("doc_id").to_pylist())
        rows = [(i, None if none else d, -s) for i, r in enumerate(best.rows) for s, none, d in r]
        for at in range(0, len(rows), 10_000):
            part = list(zip(*rows[at:at + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int32()), pa.array(part[1], index_type), pa.array(part[2], pa.int64())],
                ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    index_type = to_arrow_type(index.schema["doc_id"].dataType)
    return index.mapInArrow(run, f"item int, doc_id {id_kind}, score bigint")


def item_blocks(rows: Iterator, block_items: int, block_terms: int) -> Iterator[tuple[list, list]]:
    """``(item ids, lists of distinct terms)``, at most ``block_items`` items and, but for a single
    item that has more, ``block_terms`` distinct terms a block."""
    ids: list = []
    sets: list = []
    known: set = set()
    for item_id, text in rows:
        own = sorted(set(terms(text)))
        if not own:
            continue
        if ids and (len(ids) >= block_items or len(known.union(own)) > block_terms):
            yield ids, sets
            ids, sets, known = [], [], set()
        ids.append(item_id)
        sets.append(own)
        known.update(own)
    if ids:
        yield ids, sets


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_items: int = 1024,
           block_terms: int = 16384) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 of each row of
    ``items`` (``item_id, text``), of equal scores those of smaller id."""
    spark = docs.sparkSession
    python_ready(spark)
    sc = spark.sparkContext
    item_kind, id_kind = (d.schema[c].dataType.simpleString() for d, c in ((items, "item_id"), (docs, "doc_id")))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    split = Window.partitionBy("item", "_split").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = None
    stream = ((r["item_id"], r["text"]) for r in items.select("item_id", "text").orderBy("item_id", "text")
              .toLocalIterator())
    for ids, sets in item_blocks(stream, block_items, block_terms):
        words = sorted({t for s in sets for t in s})
        number = {t: i for i, t in enumerate(words)}
        index = materialize(forward_index(docs, sc.broadcast(number)), how="table")
        n_docs, n_all = index.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = dict(index.select(F.explode("term").alias("t")).groupBy("t").count().collect())
        shared = SharedTerms([[number[t] for t in s] for s in sets], len(words))
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(words))], np.int64)
        rows = partial_best(index, sc.broadcast((shared, weights, n_docs, n_all)), id_kind, k)
        for window in (split, best):
            rows = (rows.withColumn("_split", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_SPLITS)))
                    .withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k))
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_kind}")
        rows = rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = rows if found is None else found.union(rows)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {id_kind}, score bigint")
    return found
