import hashlib
import random
from collections import defaultdict

from seqloom.llm import exact_dedup as op
from seqloom.llm.common import LOWER, UPPER


def brute(rows):
    groups = defaultdict(list)
    low = lambda t: (t or "").translate(str.maketrans(UPPER, LOWER))
    for i, t in rows:
        groups[low(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[low(t)]
        best = max((x for x in ids if x is not None), default=None)
        out.append((i, best, len(ids), i == best, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_odd_rows(odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(op.dedup(odd)) == brute(rows) == result(op.dedup(clashing))
    assert op.dedup(none).count() == 0


def test_groups_and_case(docs_of):
    rng = random.Random(1)
    texts = [rng.choice(["Ab c", "aB C", "Äb", "äb", "", "x"]) if rng.random() < 0.9 else f"own {i}" for i in range(400)]
    assert result(op.dedup(docs_of(texts))) == brute(list(enumerate(texts)))


def test_index_inserts_deletes_and_grows():
    index, keys = op.CuckooIndex(buckets=2), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    assert all(index.insert(k, 1, i) for i, k in enumerate(keys)) and index.resizes > 3 and len(index) == 3000
    assert all(index.find(k, 1)[2] == i for i, k in enumerate(keys)) and not index.insert(keys[5], 1, 9999)
    assert index.find(keys[5], 1)[2:] == [9999, 2] and index.find(keys[5], 2) is None
    assert index.delete(keys[5], 1) and index.find(keys[5], 1) and index.delete(keys[5], 1) and index.find(keys[5], 1) is None and not index.delete(keys[5], 1)
    for k in keys[:2000]:
        index.delete(k, 1)
    assert len(index) == 1000 and all(index.find(k, 1) for k in keys[2000:]) and sum(index.may_contain(k) for k in keys[:2000]) < 40


def test_removed_rows(docs_of):
    docs = docs_of([(1, "a", None, None), (2, "A", None, None), (3, "b", None, None), (4, "c", None, None)])
    gone = docs_of([(2, "A", None, None), (4, "c", None, None), (9, "never there", None, None)])
    assert [r[:4] for r in result(op.dedup(docs, removed=gone))] == [(1, 1, 1, True), (3, 3, 1, True)]
