import random

import numpy as np

from seqloom.llm import mixing as op


def naive(votes, seats, most=None):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if votes[i] > 0 and (most is None or won[i] < most[i])), key=lambda i: (votes[i] / (2 * won[i] + 1), -i), default=None)
        if best is None:
            break
        won[best] += 1
    return won


def test_highest_quotients():
    rng = random.Random(1)
    for _ in range(200):
        votes = [rng.choice([0, 1, 7, rng.random() * 100, 50]) for _ in range(rng.randint(1, 9))]
        most = [rng.randint(0, 40) for _ in votes] if rng.random() < 0.5 else None
        seats = rng.randint(0, 120)
        assert op.sainte_lague(np.array(votes, float), seats, most).tolist() == naive(votes, seats, most)
    assert op.sainte_lague(np.array([]), 5).tolist() == []


def shares(sizes, most=3):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(full.values())
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > most * sizes[s] + 1e-9]
        if not over:
            return {**full, **{s: weight[s] * level for s in free}}
        full |= {s: most * sizes[s] for s in over}


def check(docs, rows, slack=op.BLOCK):
    got = op.plan(docs).collect()
    size = lambda t: len([w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w])
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, source = shares(sizes), {i: s for i, _, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= slack + 1 for s in sizes), (taken, want)
    return got


def test_targets_and_quotas(docs_of, passages):
    rng = random.Random(2)
    rows = [(i, passages(i, rng.randint(1, 300)), "en", rng.choice(["a", "b", "B", "é", "zz", None, "rare" if i < 3 else "a"])) for i in range(400)]
    got = check(docs_of(rows), rows)
    again = op.plan(docs_of(rows, parts=7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_many_shards(docs_of, passages):
    rows = [(i, passages(i, 50), "en", "hot" if i % 3 else "cold") for i in range(300)]
    got = op.plan(docs_of(rows), per_shard=1000).collect()
    source = {i: s for i, _, _, s in rows}
    for s in ("hot", "cold"):
        of = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in of) - of[0].target) <= op.BLOCK + 1


def test_mixed_rows(docs_of, passages):
    rows = [(i, passages(i, 40), "en", "ab"[i > 5]) for i in range(40)]
    docs = docs_of(rows)
    want = {r.doc_id: r.taken for r in op.plan(docs).collect()}
    out = op.mix(docs).collect()
    texts = {i: t for i, t, _, _ in rows}
    found = dict.fromkeys(want, 0)
    for r in out:
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        found[r.doc_id] += len(r.text.split())
    assert found == want


def test_odd_rows(odd, clashing, none):
    assert op.plan(odd).count() == odd.count()
    assert sorted(map(repr, (tuple(r)[:5] for r in op.mix(clashing).select("doc_id", "text", "lang", "source", "n_chars").collect()))) == sorted(map(repr, map(tuple, op.mix(odd).collect())))
    assert op.plan(none).count() == op.mix(none).count() == 0


def test_rows_of_one_id_and_of_none_in_any_partitioning(docs_of, passages):
    rows = [(1, passages(k, 50), "en", "a") for k in range(30)] + [(None, passages(100 + k, 50), "en", "a") for k in range(30)] + [(k, passages(200 + k, 40), "en", "b") for k in range(2, 60)]
    got = [sorted(map(repr, op.mix(docs_of(rows, parts)).collect())) for parts in (1, 5)]
    assert got[0] == got[1]
