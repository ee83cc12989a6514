"""Counterfactual-regularised toxicity classifier.

A logistic model over the words of a text and their first four and five
letters, each counted once. It is fitted on a bounded sample of labelled
documents. For every sentence that names an identity group, a counterfactual
text is made in which each identity term is swapped for another of its kind;
the loss adds the squared change of the score, so that a mention of one group
or another by itself moves nothing. Features are the words most dependent on
the label (chi squared) and the identity terms.

Defined cases: null text is an empty text, whose score is that of no features;
equal texts have equal scores; without labelled rows every score is 0.5; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready, text_or_empty
from tunedata.llm.labels import fold, labelled_sample

# Terms that name groups, by kind; a counterfactual swaps a term for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians", "americans"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"), ("disabled", "blind", "deaf"), ("old", "young"),
)
WORDS = re.compile(r"\w+")


def swaps(terms=IDENTITY_TERMS) -> dict[str, str]:
    return {t: kind[(n + 1) % len(kind)] for kind in terms for n, t in enumerate(kind)}


def features(text: str) -> set[str]:
    """Words (lower case) and, marked by a star, their first four and five letters."""
    words = set(WORDS.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in (4, 5) if len(w) > n}


def counterfactual(text: str, swap: dict[str, str]) -> str | None:
    """The text with its identity terms swapped; None if it has none."""
    changed = WORDS.sub(lambda m: swap.get(m.group(), m.group()), text.lower())
    return None if changed == text.lower() else changed


class Model:
    """Weights by feature and the intercept."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.words = {f: w for f, w in weights.items() if f[-1] != "*"}
        self.stems = {f[:-1]: w for f, w in weights.items() if f[-1] == "*"}

    def score(self, text: str) -> float:
        total, word, stem = self.intercept, self.words.get, self.stems.get
        seen = set()
        for w in set(WORDS.findall(text.lower())):
            total += word(w, 0.0)
            for s in (w[:4], w[:5]):
                if len(s) < len(w) and s in self.stems and s not in seen:
                    seen.add(s)
                    total += stem(s)
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(texts: list[str], labels: list[int], terms=IDENTITY_TERMS, max_features: int = 4000, epochs: int = 16,
        balance: float = 2.0, decay: float = 1e-4, rate: float = 0.3, seed: int = 42) -> Model:
    """Fit on labelled texts. ``balance`` weighs the squared score change."""
    if not texts:
        return Model({}, 0.0)
    swap = swaps(terms)
    sets = [features(t) for t in texts]
    y = np.array(labels, float)
    in_all, in_toxic = Counter(), Counter()
    for s, label in zip(sets, labels, strict=True):
        in_all.update(s)
        if label:
            in_toxic.update(s)
    n, pos = len(y), y.sum()
    names = sorted(in_all)
    df = np.array([in_all[f] for f in names], float)
    hit = np.array([in_toxic[f] for f in names], float)
    expected = df * pos / n
    chi = (hit - expected) ** 2 / np.maximum(expected * (1 - pos / n) * (1 - df / (n + 1)), 1e-9)
    top = np.argsort(-chi, kind="stable")[:max_features]
    kept = [names[i] for i in top if chi[i] > 6.6]  # dependent on the label at the one per cent level
    at = {f: i for i, f in enumerate(dict.fromkeys([*kept, *sorted(swap)]))}
    rows = [np.array(sorted(at[f] for f in s if f in at), np.int64) for s in sets]
    others = [counterfactual(t, swap) for t in texts]
    twins = [None if o is None else np.array(sorted(at[f] for f in features(o) if f in at), np.int64) for o in others]
    w, seen = np.zeros(len(at)), np.full(len(at), 1e-2)
    b, b_seen = 0.0, 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(n):
            x, twin = rows[i], twins[i]
            s = w[x].sum() + b
            g = 1 / (1 + np.exp(-s)) - y[i]
            grad_x = g
            if twin is not None:
                change = 2 * balance * (s - w[twin].sum() - b)
                grad_x = g + change
                seen[twin] += change * change
                w[twin] += rate * change / np.sqrt(seen[twin])
            seen[x] += grad_x * grad_x
            w[x] -= rate * (grad_x + decay * w[x]) / np.sqrt(seen[x])
            b_seen += g * g
            b -= rate * g / np.sqrt(b_seen)
    return Model({f: float(w[i]) for f, i in at.items() if w[i]}, float(b))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2500, **options) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, those not held out. Scores
    are those of evenly mixed classes: the rarity of toxic texts is not held against one."""
    learn = F.coalesce(fold(3) != 1, F.lit(False))
    sample = labelled_sample(docs, labels, "toxic", learn, per_class).orderBy("doc_id", "text").collect()
    return fit([r["text"] for r in sample], [r["label"] for r in sample], **options)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)  # at most max_features weights and the identity terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = [shared.value.score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
