"""Personal data: base patterns and a chain model over word shapes.

The base spans are those of four patterns with their checks. A linear-chain
conditional random field, fitted on a small table of lines labelled by their
base spans, tags the tokens of a line from the shapes around them, decoded by
Viterbi in numpy batches; it adds the spans that the patterns lose, as where a
match runs on into the next number and fails its check. An added span passes
the check of its kind and touches no base span. Every kind's check asks for a
digit or an at sign, so lines with neither are not decoded.

Defined cases: null text is an empty text, without spans; equal rows are
separate; without any base span in the table the model adds nothing; an empty
table gives no rows; spans count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready, text_or_empty
from tunedata.llm.crf import Chain

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, number of the kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits are entered at their start only, since no later start can match more.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, in linear time."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, end := found.end()))
        at = text.find("@", max(at + 1, end))
    return out


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(number)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: int, s: str) -> bool:
    """Whether ``s`` passes the check of its kind."""
    if kind == 0:
        return emails(s) == [(0, len(s))]
    if kind == 1:
        return bool(IP.fullmatch(s)) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
                                            for p in s.split("."))
    number = digits(s)
    if kind == 2:
        return bool(CARD.fullmatch(s)) and 14 <= len(number) <= 19 and luhn(number)
    return 10 <= len(number) <= 15


def base_spans(text: str) -> tuple[list[Span], bool]:
    """Base spans by start, then kind, and whether a match of ten digits or more failed its
    check outside of them."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    failed = []
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            if valid(kind, m.group()):
                found.append((m.start(), kind, m.end()))
            elif m.end() - m.start() >= 10 and len(digits(m.group())) >= 10:
                failed.append(m.span())
    dropped = any(not any(s <= a and b <= e for s, _, e in found) for a, b in failed)
    return sorted(found), dropped


def render(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# Shapes of tokens: digits by number, letters by case and length, space, each sign.
TOKENS = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
DIGIT_SHAPES, LETTER_SHAPES = 21, 12
SPACE_SHAPE = DIGIT_SHAPES + LETTER_SHAPES
OTHER_SHAPE, EDGE_SHAPE = SPACE_SHAPE + 1, SPACE_SHAPE + 2
SHAPES = EDGE_SHAPE + 1 + 128
WINDOW = 3


def shape(token: str) -> int:
    c = token[0]
    if "0" <= c <= "9":
        return min(len(token), DIGIT_SHAPES) - 1
    if c.isalpha():
        case = 0 if token.islower() else 1 if token.isupper() else 2
        return DIGIT_SHAPES + 4 * case + min(len(token), 4) - 1
    if c.isspace():
        return SPACE_SHAPE
    return EDGE_SHAPE + 1 + ord(c) if c < "\x80" else OTHER_SHAPE


FEATURES = (2 * WINDOW + 1) * SHAPES + 2 * SHAPES * SHAPES


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Feature ids of every token (its shape, those around it, and pairs), tokens of each line."""
    tokens = [TOKENS.findall(line) for line in lines]
    counts = np.array([len(t) for t in tokens], np.int64)
    pad = [EDGE_SHAPE] * WINDOW
    flat, real = list(pad), []
    for t in tokens:
        real.append(np.arange(len(flat), len(flat) + len(t)))
        flat += [shape(x) for x in t] + pad
    s = np.array(flat, np.int64)
    at = np.concatenate(real) if real else np.empty(0, np.int64)
    near = [s[at + d] + (d + WINDOW) * SHAPES for d in range(-WINDOW, WINDOW + 1)]
    pairs = (2 * WINDOW + 1) * SHAPES
    near.append(s[at - 1] * SHAPES + s[at] + pairs)
    near.append(s[at] * SHAPES + s[at + 1] + pairs + SHAPES * SHAPES)
    return np.stack(near, 1), counts, tokens


def fit(lines: list[tuple[str, list[Span]]], rounds: int = 60) -> Chain:
    """Fit on lines with their spans; label 0 is none, then the kinds."""
    chain = Chain(FEATURES, len(KINDS) + 1)
    if not lines:
        return chain
    ids, counts, tokens = line_features([line for line, _ in lines])
    labels = np.zeros(len(ids), np.int64)
    n = 0
    for (_, spans), line_tokens in zip(lines, tokens, strict=True):
        at = 0
        for t in line_tokens:
            inside = [k for a, k, b in spans if a <= at and at + len(t) <= b]
            labels[n] = inside[0] + 1 if inside else 0
            at += len(t)
            n += 1
    return chain.fit(ids, counts, labels, rounds)


def added_spans(chain: Chain, lines: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Valid spans that the chain finds in each line beside the line's base spans."""
    if not lines or not chain.transitions.any():
        return [[] for _ in lines]
    ids, counts, tokens = line_features(lines)
    labels = chain.best(chain.scores(ids), counts).tolist()
    out, n = [], 0
    for line, spans, line_tokens in zip(lines, base, tokens, strict=True):
        found: list[Span] = []
        at, start, current = 0, 0, 0
        for t in [*line_tokens, ""]:
            label = labels[n] if t else 0
            if label != current or (t == "+" and current == KINDS.index("phone") + 1):
                if current:
                    found += _trimmed(line, start, current - 1, at)
                start, current = at, label
            at += len(t)
            n += bool(t)
        out.append([f for f in found if not any(f[0] < b and a < f[2] for a, _, b in spans)])
    return out


def _trimmed(line: str, start: int, kind: int, end: int) -> list[Span]:
    text = line[start:end]
    start += len(text) - len(text.lstrip())
    text = text.strip()
    return [(start, kind, start + len(text))] if text and valid(kind, text) else []


def find(chain: Chain, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    out, lines, line_base, owner = [], [], [], []
    for i, text in enumerate(texts):
        if not HINT.search(text):
            out.append(([], []))
            continue
        spans, _ = base_spans(text)
        out.append((spans, list(spans)))
        start = 0
        for line in text.split("\n"):
            if HINT.search(line):
                end = start + len(line)
                lines.append(line)
                line_base.append([(a - start, k, b - start) for a, k, b in spans if a < end and b > start])
                owner.append((i, start))
            start += len(line) + 1
    for (i, start), added in zip(owner, added_spans(chain, lines, line_base), strict=True):
        out[i][1].extend((a + start, k, b + start) for a, k, b in added)
    for _, spans in out:
        spans.sort()
    return out


def windows(line: str, spans: list[Span], width: int) -> Iterator[str]:
    """The parts of a line around its digits and at signs, of about ``width`` code points; they begin
    and end outside of the spans and, but in words longer than that, at white space."""
    if len(line) <= width:
        yield line
        return
    at = 0
    while m := HINT.search(line, at):
        start, end = max(at, m.start() - width // 2), min(len(line), m.start() + width - width // 2)
        while at < start and start < m.start() and not line[start - 1].isspace():
            start += 1
        while m.end() < end < len(line) and not line[end].isspace():
            end -= 1
        for a, _, b in spans:
            if a < start < b:
                start = b if m.start() >= b else a
            if a < end < b:
                end = a if a > m.start() else b
        yield line[start:end]
        at = max(end, m.end())


def labelled_lines(docs: DataFrame, most: int = 2000, width: int = 600) -> list[tuple[str, list[Span]]]:
    """The table the chain is fitted on: at most ``most`` lines that hold a digit or an at sign
    and no failed match, with their base spans; drawn by hash, half of them with spans if
    there are enough. A line of more than ``width`` code points gives windows of about that
    width in its place, so the table is bounded in bytes and long lines are in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, spans = [], []
            for text in b.column("text").to_pylist():
                for line in text.split("\n") if HINT.search(text) else ():
                    for part in windows(line, base_spans(line)[0], width) if HINT.search(line) else ():
                        found, dropped = base_spans(part)
                        # A span of its own may still be longer than a window.
                        if not dropped and len(part) <= 2 * width:
                            lines.append(part)
                            spans.append(";".join(f"{a}:{k}:{e}" for a, k, e in found))
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(spans, pa.string())],
                                             ["line", "spans"])

    lines = docs.select(text_or_empty().alias("text")).mapInArrow(run, "line string, spans string")
    by_hash = lines.distinct().withColumn("has", F.col("spans") != "").withColumn("h", F.xxhash64("line"))
    drawn = [by_hash.filter(F.col("has") == has).orderBy("h", "line").limit(most // 2) for has in (True, False)]
    rows = drawn[0].union(drawn[1]).select("line", "spans").orderBy("line").collect()
    return [(r["line"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(";") if s]) for r in rows]


def train(docs: DataFrame, most: int = 2000, rounds: int = 50, width: int = 600) -> Chain:
    """A chain fitted on at most ``most`` lines or windows of lines of about ``width`` code points."""
    python_ready(docs.sparkSession)
    return fit(labelled_lines(docs, most, width), rounds)


def find_in_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, base counts ``n_<kind>``, ``base_sha256`` and ``spans`` of every row of ``docs``."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(chain)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find(shared.value, b.column("text").to_pylist())
            cols = [b.column("doc_id")]
            cols += [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(4)]
            cols.append(pa.array([hashlib.sha256(render(base).encode()).hexdigest() for base, _ in found], pa.string()))
            cols.append(pa.array([render(spans) for _, spans in found], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced by their kind in angle brackets; where spans meet, the
    first stands for all."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; ``n_chars``, where present, follows."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            found = find(shared.value, [t or "" for t in texts])
            new = [None if t is None else masked(t, spans) for t, (_, spans) in zip(texts, found, strict=True)]
            at = b.schema.names.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, b.column(at).type) if i == at else b.column(i) for i in range(b.num_columns)],
                schema=b.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out
