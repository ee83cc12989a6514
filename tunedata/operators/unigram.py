"""Unigram vocabularies (V1 with ``model_type=unigram``): seed pieces, EM over word lattices, pruning.

A text is a product of independent pieces; the training finds the probabilities of the
pieces by expectation maximisation and drops pieces until ``vocab_size`` are left:

1. Seeds: the covered characters and the most promising substrings of the distinct words
   (count times length, at least two occurrences), by a map-side combined count and a top-k.
2. E-step: every task runs forward-backward over the lattices of its words, in numpy for a
   batch of words at once, word counts as weights. Expected counts are summed as integers in
   units of 2^-20, so neither files nor splits change the sums.
3. M-step: the new log probabilities are ``psi(count) - psi(sum)`` (the mean under a
   Dirichlet posterior); pieces expected less than half a time go.
4. Pruning: a piece's loss is its count in the best paths times what its own best path without
   it costs. The pieces of least loss go, a quarter a round; covered characters stay.

The pieces (``seed_size`` at most) are the only data on the driver; they are broadcast, the
words never are. A character without a piece costs ``UNKNOWN`` less than the rarest piece and
stands for the unknown piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.operators import vocab
from tunedata.session import materialize, ship_package

MAX_PIECE = 16
UNKNOWN = 10.0
# Expected counts are integers in this unit; smaller expectations than half a piece go.
UNIT, LEAST_COUNT = 1 << 20, 0.5
# Words whose lattices are walked at a time, and their most characters together.
BATCH_WORDS, BATCH_CHARS = 4096, 1 << 17
SEEDS_PER_PIECE = 10
PRUNED, EM_STEPS = 0.75, 2

BUCKET_BITS = 18

_BUCKET = np.uint64(64 - BUCKET_BITS)
_MULTIPLIER, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def _extend(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h + code + np.uint64(1)) * _MULTIPLIER
    return h ^ (h >> _SHIFT)


def codes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one behind the other, and the texts' lengths."""
    return (np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64),
            np.fromiter(map(len, texts), np.int64, len(texts)))


class Model:
    """Pieces with log probabilities, found by a 64-bit hash of their code points."""

    def __init__(self, pieces: list, logp: np.ndarray):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        points, lengths = codes(pieces)
        starts = np.cumsum(lengths) - lengths
        hashes = np.zeros(len(pieces), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.longest):
                has = lengths > k
                hashes[has] = _extend(hashes[has], points[starts[has] + k])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        # Whether a piece has these first bits: most hashes that are asked for have none.
        self.filled = np.zeros(1 << BUCKET_BITS, bool)
        self.filled[hashes >> _BUCKET] = True
        self.set(logp)

    def set(self, logp: np.ndarray) -> None:
        """``logp`` of the pieces; behind them those of no piece and of an unknown character."""
        least = float(logp.min()) if len(logp) else 0.0
        self.logp = np.concatenate([logp, [-np.inf, least - UNKNOWN]])

    @property
    def unknown(self) -> int:
        return len(self.pieces) + 1


class Lattice:
    """All pieces inside a batch of words; ``own`` are words' own piece numbers, left out of their lattices."""

    def __init__(self, model: Model, words: list, own: np.ndarray | None = None):
        self.order = np.argsort([-len(w) for w in words], kind="stable")
        words = [words[i] for i in self.order]
        points, self.length = codes(words)
        self.start = np.cumsum(self.length) - self.length
        self.most = int(self.length[0]) if len(words) else 0
        # Of the words, longest first, those that have a k-th character.
        self.reach = [int(n) for n in np.searchsorted(-self.length, -np.arange(self.most + 1), side="right")]
        left = np.repeat(self.start + self.length, self.length) - np.arange(len(points))
        h = np.zeros(len(points), np.uint64)
        self.ids: list = []
        with np.errstate(over="ignore"):
            for k in range(min(model.longest, self.most)):
                inside = np.flatnonzero(left > k)
                h[inside] = _extend(h[inside], points[inside + k])
                found = np.full(len(points), len(model.pieces), np.int64)
                some = inside[model.filled[h[inside] >> _BUCKET]]
                if len(some):
                    at = np.minimum(np.searchsorted(model.hashes, h[some]), len(model.hashes) - 1)
                    same = model.hashes[at] == h[some]
                    found[some[same]] = model.order[at[same]]
                if k == 0:
                    found[found == len(model.pieces)] = model.unknown
                self.ids.append(found)
        if own is not None:
            for w, piece in enumerate(own[self.order].tolist()):
                n = int(self.length[w])
                if 1 < n <= len(self.ids) and self.ids[n - 1][self.start[w]] == piece:
                    self.ids[n - 1][self.start[w]] = len(model.pieces)

    def _steps(self, k: int):
        """``(length, piece numbers)`` of the pieces that end behind the k-th character of the words that have one."""
        m = self.reach[k]
        for n in range(1, min(k, len(self.ids)) + 1):
            yield n, self.ids[n - 1][self.start[:m] + k - n]

    def best(self, logp: np.ndarray) -> tuple[np.ndarray, list]:
        """Best paths' scores, and for each word the piece numbers of its best path; of equal paths
        the one whose last piece is shorter, then the one before it."""
        score = [np.zeros(len(self.length))]
        back = [np.zeros(len(self.length), np.int64)]
        for k in range(1, self.most + 1):
            m = self.reach[k]
            now, length = np.full(m, -np.inf), np.ones(m, np.int64)
            for n, ids in self._steps(k):
                s = score[k - n][:m] + logp[ids]
                better = s > now
                now[better], length[better] = s[better], n
            score.append(now)
            back.append(length)
        total, paths = np.zeros(len(self.length)), [None] * len(self.length)
        for w, (n, start) in enumerate(zip(self.length.tolist(), self.start.tolist(), strict=True)):
            total[w], path, k = score[n][w], [], n
            while k:
                step = int(back[k][w])
                path.append(int(self.ids[step - 1][start + k - step]))
                k -= step
            paths[w] = path[::-1]
        unsorted = np.argsort(self.order)
        return total[unsorted], [paths[i] for i in unsorted]

    def expected(self, logp: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces, in ``UNIT``s, and behind them the weighted log likelihood."""
        weight = weight[self.order]
        forward = [np.zeros(len(self.length))]
        for k in range(1, self.most + 1):
            forward.append(_log_sum([forward[k - n][:self.reach[k]] + logp[ids] for n, ids in self._steps(k)]))
        z = np.array([forward[n][w] for w, n in enumerate(self.length.tolist())])
        backward: list = [None] * (self.most + 1)
        at, parts = [np.zeros(0, np.int64)], [np.zeros(0)]
        for k in range(self.most, -1, -1):
            m = self.reach[k]
            terms = [np.where(self.length[:m] == k, 0.0, -np.inf)]
            for n in range(1, min(self.most - k, len(self.ids)) + 1):
                r = self.reach[k + n]
                ids = self.ids[n - 1][self.start[:r] + k]
                s = np.full(m, -np.inf)
                s[:r] = logp[ids] + backward[k + n]
                terms.append(s)
                at.append(ids)
                parts.append(np.rint(np.exp(forward[k][:r] + s[:r] - z[:r]) * weight[:r] * UNIT))
            backward[k] = _log_sum(terms)
        ids, p = np.concatenate(at), np.concatenate(parts)
        if p.sum() < 1 << 52:  # whole numbers that doubles add up exactly
            counts = np.bincount(ids, p, len(logp)).astype(np.int64)
        else:
            counts = np.zeros(len(logp), np.int64)
            np.add.at(counts, ids, p.astype(np.int64))
        counts[-2:] = 0
        return np.append(counts[:-2], np.rint((z * weight).sum()).astype(np.int64))


def _log_sum(terms: list) -> np.ndarray:
    stacked = np.stack(terms)
    top = stacked.max(0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(stacked - safe).sum(0))


def digamma(x: np.ndarray) -> np.ndarray:
    """The logarithmic derivative of the gamma function, for positive ``x``."""
    x, out = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(7):
        small = x < 7
        out = np.where(small, out - 1 / np.where(small, x, 1), out)
        x = np.where(small, x + 1, x)
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


# ------------------------------------------------------------------- training
def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """Words and counts, some thousands at a time."""
    words: list = []
    counts: list = []
    size = 0
    for b in batches:
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
            words.append(word)
            counts.append(n)
            size += len(word)
            if len(words) >= BATCH_WORDS or size >= BATCH_CHARS:
                yield words, np.array(counts, np.float64)
                words, counts, size = [], [], 0
    if words:
        yield words, np.array(counts, np.float64)


def _totals(rows: DataFrame, size: int) -> np.ndarray:
    """Sums of ``n`` by ``piece``: one row a piece reaches the driver."""
    got = rows.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[got.column("piece").to_numpy()] = got.column("n").to_numpy()
    return out


def _sparse(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["piece", "n"])


def expectation(words: DataFrame, model: Model) -> tuple[np.ndarray, int]:
    """Expected counts of the pieces (in ``UNIT``s) and the log likelihood over ``words`` (``word, n``)."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total = np.zeros(len(m.pieces) + 1, np.int64)
        for part, n in _batches(batches):
            total += Lattice(m, part).expected(m.logp, n)
        yield _sparse(total)

    out = _totals(words.mapInArrow(run, "piece bigint, n bigint"), len(model.pieces) + 1)
    return out[:-1], int(out[-1])


def best_counts(words: DataFrame, model: Model) -> np.ndarray:
    """How often each piece is in the best paths of ``words``."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total = np.zeros(len(m.logp), np.int64)
        for part, n in _batches(batches):
            for path, times in zip(Lattice(m, part).best(m.logp)[1], n.astype(np.int64).tolist(), strict=True):
                for piece in path:
                    total[piece] += times
        yield _sparse(total[:-2])

    return _totals(words.mapInArrow(run, "piece bigint, n bigint"), len(model.pieces))


def replacement_costs(spark, model: Model) -> np.ndarray:
    """What a piece's log probability is above that of the best path over it that does without it."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            numbers = b.column("id").to_numpy()
            for at in range(0, len(numbers), BATCH_WORDS):
                part = numbers[at:at + BATCH_WORDS]
                score, _ = Lattice(m, [m.pieces[i] for i in part], part).best(m.logp)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(m.logp[part] - score, pa.float64())],
                                                 ["piece", "cost"])

    got = spark.range(len(model.pieces)).mapInArrow(run, "piece bigint, cost double").toArrow()
    out = np.zeros(len(model.pieces))
    out[got.column("piece").to_numpy()] = got.column("cost").to_numpy()
    return out


def seeds(words: DataFrame, chars: list, seed_size: int, max_piece: int = MAX_PIECE) -> Model:
    """Characters and the ``seed_size`` substrings (two characters or more, at least twice) of highest
    count times length, ties to the smaller one, with log probabilities in proportion."""
    size = F.length("word")
    spans = F.explode(F.sequence(F.lit(1), size)).alias("at")
    cut = (words.select("word", "n", spans)
           .select("word", "n", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_piece), size - F.col("at") + 1))).alias("k"))
           .select(F.substring("word", F.col("at"), F.col("k")).alias("piece"), "n", "k"))
    counts = cut.groupBy("piece", "k").agg(F.sum("n").alias("n"))
    value = F.col("n") * F.col("k")
    mark = vocab.WORD_MARK
    # A mark inside of a piece would stand for a space that ends a word.
    top = (counts.filter((F.col("k") > 1) & (F.col("n") > 1) & ~F.col("piece").substr(2, max_piece).contains(mark))
           .orderBy(value.desc(), "piece").limit(seed_size).select("piece", value.alias("v")).collect())
    single = dict(counts.filter(F.col("k") == 1).join(words.sparkSession.createDataFrame([(c,) for c in chars], "piece string"),
                                                      "piece", "left_semi").select("piece", "n").collect())
    pieces = [*chars, *[r["piece"] for r in top]]
    value = np.array([*[single.get(c, 1) for c in chars], *[r["v"] for r in top]], np.float64)
    return Model(pieces, np.log(value) - math.log(value.sum()) if len(value) else value)


def maximised(model: Model, expected: np.ndarray, n_chars: int) -> Model:
    """The model of the expected counts; rare pieces, other than the first ``n_chars``, are left out."""
    counts = expected / UNIT
    keep = counts >= LEAST_COUNT
    keep[:n_chars] = True
    counts = np.maximum(counts[keep], LEAST_COUNT)
    return Model([p for p, k in zip(model.pieces, keep.tolist(), strict=True) if k], digamma(counts) - digamma(counts.sum()))


def pruned(words: DataFrame, model: Model, n_chars: int, size: int) -> Model:
    """The model without the pieces whose loss is least, ``size`` pieces or ``n_chars`` characters left."""
    loss = best_counts(words, model) * replacement_costs(words.sparkSession, model)
    rest = np.arange(n_chars, len(model.pieces))
    order = sorted(rest.tolist(), key=lambda i: (-loss[i], model.pieces[i]))
    kept = [*range(n_chars), *sorted(order[:max(0, size - n_chars)])]
    return Model([model.pieces[i] for i in kept], model.logp[kept])


def train(words: DataFrame, chars: list, size: int, seed_size: int | None = None, em_steps: int = EM_STEPS,
          max_piece: int = MAX_PIECE) -> Model:
    """A model of at most ``size`` pieces over ``words`` (``word, n``), every one of ``chars`` among them."""
    spark = words.sparkSession
    ship_package(spark)
    model = seeds(words, chars, seed_size or SEEDS_PER_PIECE * size, max_piece)
    if not model.pieces:
        return model

    def fitted(model: Model) -> Model:
        for _ in range(em_steps):
            model = maximised(model, expectation(words, model)[0], len(chars))
        return model

    model = fitted(model)
    while len(model.pieces) > size:
        model = pruned(words, model, len(chars), max(size, int(PRUNED * len(model.pieces))))
        model = fitted(model)
    return model


def unigram_vocab(corpus: DataFrame, vocab_size: int = vocab.DEFAULT_VOCAB_SIZE, text_col: str = "value",
                  coverage: float = vocab.DEFAULT_COVERAGE, user_symbols=vocab.DEFAULT_USER_SYMBOLS, **options) -> DataFrame:
    """V1, unigram: fixed pieces, then pieces by log probability (their score), ties to the smaller piece.

    Words, marks, coverage and user symbols are those of ``vocab.bpe_vocab``; a piece that spells a
    fixed one is left out. ``options`` go to ``train``.
    """
    spark = corpus.sparkSession
    fixed = vocab.fixed_pieces(spark, user_symbols)
    names = [*vocab.SPECIAL_PIECES, *user_symbols]
    # Bounded by the code space.
    counted = materialize(vocab.counted_words(corpus, text_col, user_symbols))
    covered = vocab.covered_chars(corpus, text_col, coverage, user_symbols, counted)
    chars = [r["token"] for r in covered.orderBy("rank").collect()]
    room = vocab_size - len(names)
    if room < len(chars):
        raise ValueError(f"vocab_size {vocab_size} is too small for the fixed pieces and covered characters")
    words = materialize(vocab.bpe_words(corpus, text_col, user_symbols, counted)
                        .select(F.replace("sym", F.lit(" "), F.lit("")).alias("word"), "n"))
    model = train(words, chars, room, **options)
    score = model.logp[:len(model.pieces)].tolist()
    ranked = sorted((-s, p) for s, p in zip(score, model.pieces, strict=True) if p not in names)
    rows = [(p, len(names) + i, -s, "normal") for i, (s, p) in enumerate(ranked)]
    return fixed.unionByName(spark.createDataFrame(rows, vocab.VOCAB_SCHEMA))
