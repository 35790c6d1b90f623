import random

import pytest

from seqloom.llm import near_dedup as op
from seqloom.llm.graph import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets, root = {}, {}
    for i, t in rows:
        if i is not None:
            sets[i], root[i] = shingles(t), i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(passages, rng, seed, n, words, edits):
    base, out = passages(seed, words).split(), []
    for _ in range(n):
        x = list(base)
        for _ in range(rng.randint(0, edits)):
            x[rng.randrange(len(x))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(x))
    return out


def check(docs_of, texts, percent=85):
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in op.near_duplicates(docs_of(texts), percent).collect()}
    want = brute(rows, percent)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want and all(r.kept == (r.component_id == i) for i, r in got.items())
    return want


def test_families(docs_of, passages):
    rng = random.Random(1)
    texts = [t for s in range(12) for t in family(passages, rng, s, 8, rng.choice([30, 120, 400]), 9)] + [passages(100 + k, 60) for k in range(40)] + ["two words", "Two  WORDS", "", None] * 2
    rng.shuffle(texts)
    want = check(docs_of, texts)
    assert len({c for _, c in want.values()}) < len(texts) - 20


@pytest.mark.parametrize("percent", [80, 85])
def test_one_large_family(docs_of, passages, percent):
    rng = random.Random(2)
    check(docs_of, family(passages, rng, 7, 300, 150, 5), percent)


def test_sizes_that_just_fit(docs_of, passages):
    """Texts of 100 shingles and their prefixes of 82, alone in their regions, are linked at 80 percent."""
    whole = [passages(300 + k, 104) for k in range(12)]
    texts = [t for w in whole for t in (w, " ".join(w.split()[:86]))]
    want = check(docs_of, texts, 80)
    assert [c for _, c in want.values()] == [i - i % 2 for i in range(24)]


def test_regions_across_partition_bounds(docs_of, passages, monkeypatch):
    """Partitions of some 40 rows cut most regions, and those of more rows than that have several parts."""
    monkeypatch.setattr(op, "PART", 40)
    rng = random.Random(12)
    texts = [t for seed in (3, 5) for t in family(passages, rng, seed, 90, 120, 4)]
    check(docs_of, texts + [passages(700 + k, 60) for k in range(60)], 80)


def test_large_regions_are_compared_in_blocks(passages):
    """Texts of equal bands beyond a region's size meet in some block pair when a component differs."""
    import numpy as np
    import pandas as pd

    n = 3 * op.REGION + 10
    comp = np.zeros(n, np.int64)
    comp[[5, 600]] = [1, 2]
    pdf = pd.DataFrame({"tree": np.zeros(n, np.int32), "rep": np.arange(n), "comp": comp, "n_shingles": np.full(n, 100), "band": [b"abcdefgh"] * n})
    met = {i: set() for i in (5, 600)}
    for _, g in pd.concat(list(op._regions([pdf], True))).groupby("region"):
        assert len(g) <= 2 * op.REGION
        for i in met:
            if i in set(g["rep"]):
                met[i] |= set(g["rep"])
    assert all(len(m) == n for m in met.values())


def test_copies_and_order(docs_of, passages):
    text = passages(5, 80)
    check(docs_of, [text, text.upper(), passages(6, 80)] + [text] * 200)


def test_odd_rows(odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute(rows, 80)
    for df in (odd, clashing):
        got = op.near_duplicates(df, 80).collect()
        assert len(got) == len(rows) and all(r.kept for r in got if r.doc_id is None)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert op.near_duplicates(none).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
