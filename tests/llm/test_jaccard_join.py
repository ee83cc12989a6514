import random

import numpy as np
import pytest

from tunedata.llm import jaccard_join as jj


def plain_sets(docs, words):
    out = []
    for d, text in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for gap in "\t\n\v\f\r":
            w = w.replace(gap, " ")
        w = [x for x in w.split(" ") if x]
        out.append({" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def brute(docs, words, percent):
    sets = plain_sets(docs, words)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if sets[i] and d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))),
                  key=str)


def found(spark, docs, words=4, percent=85, **options):
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id bigint, text string, n int, key string")
    return sorted((tuple(r) for r in jj.near_duplicates(frame.repartition(4), words=words, percent=percent, **options)
                   .collect()), key=str)


def edited(rng, words, vocabulary, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


@pytest.fixture(scope="module")
def docs():
    """Chains of edits around the threshold, copies, a passage that many share, and odd texts."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        now = rng.choices(vocabulary, k=rng.choice([30, 60, 150, 400]))
        for _ in range(rng.randint(2, 9)):
            rows.append(now)
            now = edited(rng, now, vocabulary, rng.choice([0, 1, 2, 3, 6]))
    passage = rng.choices(vocabulary, k=50)
    rows += [passage + rng.choices(vocabulary, k=rng.randint(0, 40)) for _ in range(60)]
    rows += [rng.choices(vocabulary[:6], k=rng.randint(1, 9)) for _ in range(60)]
    texts = [" ".join(r) for r in rows]
    texts += [None, "", " \t\n ", "one", "One", "a b", "a  b ", "a b c", "A B C d", "é É", "é é", texts[0], texts[0] + "\n"]
    out = list(enumerate(texts))
    rng.shuffle(out)
    return [*out, out[3], out[3], (None, texts[5]), (None, "all its own words here and no others"), (None, None)]


@pytest.mark.parametrize("options", [{}, {"heavy": 4, "block": 8}])
def test_against_brute_force(spark, docs, options):
    assert found(spark, docs, **options) == brute(docs, 4, 85)


def test_other_threshold_and_width(spark, docs):
    assert found(spark, docs, words=2, percent=60, heavies=0, block=20) == brute(docs, 2, 60)


def test_empty_and_blank_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(2, None), (1, " ")]) == [(1, 0, 1), (2, 0, 2)]


def test_walk_keeps_every_pair_that_can_link():
    """The dual walk over two blocks loses no pair of different components, and leaves most others out."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 62, rng.integers(60, 200))
        sets += [np.unique(np.concatenate([base[rng.random(len(base)) > 0.04], rng.integers(0, 1 << 62, 2)]))
                 for _ in range(5)]
    members = [{"sid": i, "label": i, "n": len(s), "rest": len(s), "bits": jj.bitmap(s)} for i, s in enumerate(sets)]

    def block(m):
        import pyarrow as pa
        row = jj.pack(m)
        return jj.Block(*[pa.scalar(row[c]) for c in ("sid", "label", "n", "rests")], pa.scalar(row["bits"], pa.binary()))

    left, right = block(members[:120]), block(members[120:])
    pairs = set()
    for a, b, same in ((left, left, True), (right, right, True), (left, right, False)):
        u, v = jj.walk(a, b, 85, same)
        pairs |= set(zip(u.tolist(), v.tolist(), strict=True))
    true = {(i, j) for j in range(len(sets)) for i in range(j)
            if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j]))}
    assert true and true <= pairs
    assert len(pairs) < 2 * len(true) < len(sets) ** 2 / 40


def test_sets_of_pairs_without_a_row_for_each_side(spark, monkeypatch):
    """The sets whose texts are looked up: each side's distinct ones, no rows are made of the pairs."""
    asked = []
    real = jj.materialize

    def spy(df, **how):
        if df.columns == ["sid"]:
            asked.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, **how)

    monkeypatch.setattr(jj, "materialize", spy)
    docs = [(i, " ".join(f"w{k}" for k in range(40) if k != i)) for i in range(41, 35, -1)] + [(1, "a b c d e"), (2, "a b c d e")]
    assert found(spark, docs) == brute(docs, 4, 85)
    assert asked and not any("Generate" in plan for plan in asked)


def test_bitmaps_differ_in_no_more_bits_than_sets_in_shingles_and_in_most_of_them():
    """Also where sets of unlike size have bitmaps of unlike width."""
    rng = np.random.default_rng(8)
    seen = total = 0
    for n in (1, 3, 40, 120, 500, 2000):
        for part in (0.0, 0.1, 0.2, 0.6):
            base = rng.integers(0, 1 << 62, n)
            other = np.unique(np.concatenate([base[rng.random(n) > part], rng.integers(0, 1 << 62, int(n * part) + 1)]))
            base = np.unique(base)
            apart = len(np.setxor1d(base, other))
            bits = jj.differing(jj.bitmap(base), jj.bitmap(other))
            assert bits <= apart
            if part in (0.1, 0.2):
                seen, total = seen + bits, total + apart
    assert seen > 0.85 * total


def test_pairs_left_by_the_walk_of_near_copies_are_those_that_link():
    """Copies of one text, each two of them a little below the threshold: their bitmaps tell them from links."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 150)
    sets = [np.unique(np.concatenate([base[rng.permutation(150)[:139]], rng.integers(0, 1 << 62, 5)])) for _ in range(200)]
    row = jj.pack([{"sid": i, "label": i, "n": len(s), "rest": len(s), "bits": jj.bitmap(s)} for i, s in enumerate(sets)])
    block = jj.Block(*[pa.scalar(row[c]) for c in ("sid", "label", "n", "rests")], pa.scalar(row["bits"], pa.binary()))
    u, v = jj.walk(block, block, 85, True)
    common = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    n = np.array([len(s) for s in sets])
    links = np.triu(185 * common >= 85 * (n[:, None] + n), 1)
    assert not np.setdiff1d(np.flatnonzero(links), 200 * u + v).size
    assert len(set(zip(u.tolist(), v.tolist(), strict=True))) == len(u) < links.sum() + 0.05 * 200 * 199 / 2


def test_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """The pairs to compare grow with a group of near copies, not with its square."""
    counts = []
    real = jj.SetJoin.linked

    def spy(self, pairs):
        counts.append(pairs.count())
        return real(self, pairs)

    monkeypatch.setattr(jj.SetJoin, "linked", spy)
    rng = random.Random(3)
    passage = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(edited(rng, passage, [f"x{i}_{k}" for k in range(9)], rng.choice([2, 3, 4, 5]))))
            for i in range(300)]
    assert found(spark, docs) == brute(docs, 4, 85)
    assert counts[1] < 300
