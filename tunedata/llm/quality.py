"""Document quality from a chain model over lines.

Every line is described by binned measures of its characters and words, its
neighbours by the same measures; a linear-chain conditional random field
labels the lines good or bad. A document's score is the mean probability of
good over its lines, weighted by their length. Lines take the label of their
document for fitting, on a bounded sample.

Defined cases: null text is an empty text (one empty line); equal texts have
equal scores; without labelled rows every score is 0.5; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready, text_or_empty
from tunedata.llm.crf import Chain
from tunedata.llm.labels import fold, labelled_sample

# Upper edges of the bins of each measure; a value on an edge is in the bin above.
EDGES = (
    (1, 8, 20, 40, 80, 160, 320, 640, 1280, 5000),  # bytes
    (1, 2, 4, 8, 16, 32, 64, 128, 512),  # words
    (2.5, 3.5, 4.5, 5.5, 6.5, 8, 10, 14, 20),  # bytes a word
    (0.2, 0.4, 0.55, 0.7, 0.85, 0.95, 1.0),  # different words, of all words
    (0.001, 0.03, 0.1, 0.25, 0.5),  # words equal to the one before
    (0.001, 0.02, 0.06, 0.15, 0.4, 0.8),  # upper-case letters, of all letters
    (0.001, 0.02, 0.05, 0.15, 0.4),  # digits, of all bytes
    (0.001, 0.01, 0.03, 0.08, 0.2, 0.4),  # signs other than sentence marks
    (0.001, 0.01, 0.03, 0.06, 0.12, 0.25),  # sentence marks
    (0.05, 0.1, 0.14, 0.18, 0.25),  # white space
    (0.001, 0.05, 0.15, 0.4),  # bytes beyond ASCII
    (0.001, 0.01, 0.04, 0.1),  # exclamation marks
    (0.5,),  # an earlier line of the text is the same
    (0.5,),  # ends with a sentence mark
    (0.5,),  # starts with an upper-case letter
)
BINS = max(map(len, EDGES)) + 1
MEASURES = len(EDGES)
# A line's own bins, those of the line before and the line after, and a constant.
FEATURES = 3 * MEASURES * (BINS + 1) + 1

UPPER, LETTER, DIGIT, SIGN, MARK, BLANK, BEYOND, CALL = range(8)


def _byte_classes() -> np.ndarray:
    """For each class, 1 for the bytes that are in it."""
    out = np.zeros((8, 256), np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[BEYOND, b] = 1
            out[LETTER, b] = b >= 0xC0  # the first byte of a character
        elif c.isalpha():
            out[LETTER, b] = 1
            out[UPPER, b] = c.isupper()
        elif c.isdigit():
            out[DIGIT, b] = 1
        elif c in " \t\n\r\v\f":
            out[BLANK, b] = 1
        elif c in ".,;:?!'\"()-":
            out[MARK, b] = 1
            out[CALL, b] = c == "!"
        else:
            out[SIGN, b] = 1
    return out


CLASSES = _byte_classes()


def _word_measures(line: bytes) -> tuple[int, int, int]:
    words = line.split()
    return len(words), len(set(words)), sum(map(eq, words, words[1:]))


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids of every line, lines of each text, and bytes of each line."""
    documents = [t.encode().split(b"\n") for t in texts]
    counts = np.array([len(d) for d in documents], np.int64)
    lines = [line for d in documents for line in d]
    size = np.array([len(line) for line in lines], np.int64)
    raw = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)  # every line with its end, so none is empty
    starts = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    per = [np.add.reduceat(CLASSES[k][raw], starts, dtype=np.int64) for k in range(8)]
    per[BLANK] -= 1
    words = np.array([_word_measures(line) for line in lines], np.int64).reshape(-1, 3)
    again = np.array([seen for d in documents for seen in _repeats(d)], float)
    n, w = np.maximum(size, 1), np.maximum(words[:, 0], 1)
    ends = np.array([line.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') for line in lines], float)
    heads = np.array([line.lstrip()[:1].isupper() for line in lines], float)
    measures = [size, words[:, 0], (size - per[BLANK]) / w, np.where(words[:, 0], words[:, 1] / w, 1.0),
                words[:, 2] / w, per[UPPER] / np.maximum(per[LETTER], 1), per[DIGIT] / n, per[SIGN] / n,
                per[MARK] / n, per[BLANK] / n, per[BEYOND] / n, per[CALL] / n, again, ends, heads]
    bins = np.stack([np.searchsorted(e, m, "right") for e, m in zip(EDGES, measures, strict=True)], 1)
    own = bins + np.arange(MEASURES) * (BINS + 1)
    none = np.full(MEASURES, BINS) + np.arange(MEASURES) * (BINS + 1)  # no line there
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    before = np.vstack([none[None], own[:-1]])
    before[first] = none
    after = np.vstack([own[1:], none[None]])
    after[first + counts - 1] = none
    block = MEASURES * (BINS + 1)
    constant = np.full((len(lines), 1), FEATURES - 1)
    return np.hstack([own, before + block, after + 2 * block, constant]), counts, size


def _repeats(lines: list[bytes]) -> list[bool]:
    seen, out = set(), []
    for line in lines:
        out.append(bool(line) and line in seen)
        seen.add(line)
    return out


def document_scores(chain: Chain, texts: list[str]) -> list[float]:
    """Length-weighted mean probability of good over the lines of each text."""
    if not texts:
        return []
    ids, counts, size = line_features(texts)
    good = chain.marginals(chain.scores(ids), counts)[0][:, 1]
    owner = np.repeat(np.arange(len(texts)), counts)
    weight = size + 1.0
    total = np.bincount(owner, weight, len(texts))
    return np.clip(np.bincount(owner, good * weight, len(texts)) / total, 0.0, 1.0).tolist()


def fit(texts: list[str], labels: list[int], rounds: int = 60) -> Chain:
    chain = Chain(FEATURES, 2)
    if not texts:
        return chain
    ids, counts, _ = line_features(texts)
    return chain.fit(ids, counts, np.repeat(np.array(labels, np.int64), counts), rounds)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, rounds: int = 60) -> Chain:
    """Fit on at most ``per_class`` labelled documents of each class, those not held out."""
    learn = F.coalesce(fold(5) != 0, F.lit(False))
    sample = labelled_sample(docs, labels, "quality", learn, per_class).orderBy("doc_id", "text").collect()
    return fit([r["text"] for r in sample], [r["label"] for r in sample], rounds)


def score_documents(docs: DataFrame, chain: Chain, threshold: float = 0.3, keep: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; with ``keep`` instead the
    rows of ``docs``, all their columns, that score at least ``threshold``."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(chain)  # a few hundred weights

    if keep:
        def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                score = document_scores(shared.value, [t or "" for t in b.column("text").to_pylist()])
                yield b.filter(pa.array([s >= threshold for s in score], pa.bool_()))

        return docs.mapInArrow(filtered, docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = document_scores(shared.value, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
