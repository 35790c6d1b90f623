import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import quality_classifier as clf
from seqloom.llm import quality_rules as rules
from seqloom.llm.common import hashed_words


def corpus(passages, n):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words, toxic, low = passages(i, 80).split(), rng.random() < 0.25, rng.random() < 0.25
        if toxic:
            for _ in range(4):
                words[rng.randrange(80)] = rng.choice(["vile", "foul", "nasty"])
        text = " ".join(w + "$$$" for w in words) if low else " ".join(words)
        rows.append((i, text, "en", f"s{i % 4}"))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, docs_of, passages):
    rows, labels = corpus(passages, 900)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in clf.classify(docs_of(rows), known).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert sum((got[i].p_low >= 0.5) != (q == 0) for i, q, _ in held) <= 0.02 * len(held)
    assert sum((got[i].p_toxic >= 0.5) != bool(t) for i, _, t in held) <= 0.03 * len(held)
    assert sum(not got[i].kept for i, q, t in held if q and not t) <= 0.02 * len(held)


def test_pool_is_labelled_by_either_view(passages):
    rows, labels = corpus(passages, 600)
    tokens = clf.Tokens()
    text = [clf.text_features(t, tokens) for _, t, _, _ in rows]
    meta = np.array([clf.metadata_features(t, lang, source) for _, t, lang, source in rows], float)
    y = np.array([int(q == 0) if i % 2 else -1 for i, q, _ in labels])
    held = np.array([i % 4 == 1 for i in range(600)])
    model = clf.co_train(text, meta, y, held)
    assert len(model.added) == clf.ROUNDS and min(model.added[-1]) > 50
    assert clf.co_train(text, meta, np.where(y > 0, -1, y), held) is None


def test_fitting_takes_little_memory():
    """Features are counted by blocks of rows: no array over all of them, and the same weights."""
    rng = np.random.default_rng(3)
    y = (np.arange(6_000) % 3 == 0).astype(float)
    rows = [np.unique(np.concatenate([[0, 7 + int(y[i])], rng.integers(100, 50_000, 600)])).astype(np.int32) for i in range(len(y))]
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, ones = np.bincount(flat, minlength=1 << clf.BITS), np.bincount(flat, y[owner], 1 << clf.BITS)
    far = abs(ones - n * y.mean()) / np.sqrt(n * y.mean() * (1 - y.mean()) + 1e-9) >= clf.STRAY
    del flat, owner
    tracemalloc.start()
    w = clf.fit_text(rows, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak  # 3.6 M features; arrays over all of them took 24 bytes each and more
    assert w[7] < 0 < w[8] and not w[np.flatnonzero(~((n >= clf.FEWEST) & far))[1:]].any()
    whole = []
    for size in (7, 10_000):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(clf, "BLOCK", size)
            whole.append(clf.fit_text(rows[:600], y[:600]))
    assert (whole[0] == whole[1]).all()


def test_the_driver_gives_memory_back(docs_of, passages, monkeypatch):
    """After the models are fitted, with or without rows."""
    calls = []
    monkeypatch.setattr(clf, "released", lambda: calls.append(1))
    docs = docs_of([passages(i, 20) for i in range(4)])
    clf.fit(docs, docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).limit(0))
    assert calls


def test_classifier_on_odd_rows(spark, odd, clashing, none, docs_of, passages):
    rows, labels = corpus(passages, 200)
    known = spark.createDataFrame([*labels, (None, 1, 0), (1, None, None), (2, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    models = clf.fit(docs_of(rows), known)
    for df in (odd, clashing):
        out = clf.score(df, models).collect()
        assert len(out) == odd.count() and all(0 <= r.p_low <= 1 for r in out)
    assert clf.classify(none, known).count() == 0
    assert all(r.kept and r.p_low == 0 for r in clf.classify(odd, known.limit(0)).collect())


def statistics(text):
    text = text or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, x in enumerate(tri) if tri.count(x) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_statistics(passages):
    rng = random.Random(1)
    texts = [None, "", " \n", "a a a a", "x y z x y z", "l\nl\n\nl \n", "é# 日本 <b>\x0b* x", "\x1c a\x85b"] + ["".join(rng.choice("ab \n#日") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for t in texts:
        assert rules.base_statistics(t, hashed_words(t)) == statistics(t), repr(t)


def kneser_ney(texts):
    """Probability of each 5-gram of symbols in marked words, by the definition, with dictionaries."""
    top = Counter()
    for t in texts:
        for w in (t or "").split():
            s = ["^"] * 4 + [*w, "$"]
            top.update(tuple(s[i - 4 : i + 1]) for i in range(4, len(s)))
    tables = {5: top}
    for m in range(5, 1, -1):
        tables[m - 1] = Counter(g[1:] for g in tables[m])
    p = {}
    for m in range(1, 6):
        t = tables[m]
        k = Counter(min(c, 4) if c < 4 else c for c in t.values())
        d = {1: 0.5, 2: 0.75, 3: 0.9}
        if k[1] and k[2] and k[3]:
            y = k[1] / (k[1] + 2 * k[2])
            d = {i: min(max(i - (i + 1) * y * k[i + 1] / k[i], (0, 0.05, 0.1, 0.15)[i]), (0, 0.95, 1.9, 2.85)[i]) for i in (1, 2, 3)}
        total, left, size = Counter(), Counter(), Counter()
        for g, c in t.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
            size[g[:-1]] += 1
        for g, c in t.items():
            lower = p[g[1:]] if m > 1 else 1 / size[()]
            p[g] = (c - d[min(c, 3)]) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * lower
    return p


def mean_log_perplexity(text, p):
    words = (text or "").split()
    marked = [["^"] * 4 + [*w, "$"] for w in words]
    logs = [math.log(p[tuple(w[i : i + 5])]) for w in marked for i in range(len(w) - 4)]
    return -sum(logs) / len(words) if words else None


def test_model_and_scores_against_brute_force(docs_of, passages, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "de", None, ""])
        text = " ".join(rng.choice(passages(k % 5, 40).split()) for k in range(rng.randint(0, 90))) + rng.choice(["", " ünï 日本😀 x", "\n\tEND!!"])
        rows.append((i, rng.choice([text, text, text, None, ""]), lang, "s"))
    models = {lang: kneser_ney([t for _, t, x, _ in rows if x == lang]) for lang in ("en", "de", None, "")}
    docs = docs_of(rows)
    for limit in (rules.BROADCAST_GRAMS, 0):
        monkeypatch.setattr(rules, "BROADCAST_GRAMS", limit)
        monkeypatch.setattr(rules, "BLOCK", 10_000)
        model = rules.probabilities(rules.count_grams(docs))
        got = {r.doc_id: r.log_perplexity for r in rules.score(docs, model).collect()}
        for i, t, lang, _ in rows:
            want = mean_log_perplexity(t, models[lang])
            assert got[i] is None if want is None else math.isclose(got[i], want, abs_tol=2e-5), (i, got[i], want)


def test_long_texts_and_many_grams(docs_of, passages, monkeypatch):
    monkeypatch.setattr(rules, "HELD", 50)
    texts = [passages(1, 120_000), passages(2, 10), "x" * 600_000]
    docs = docs_of([(i, t, "en", "s") for i, t in enumerate(texts)])
    p = kneser_ney(texts)
    got = {r.doc_id: r.log_perplexity for r in rules.score(docs, rules.probabilities(rules.count_grams(docs))).collect()}
    assert all(math.isclose(got[i], mean_log_perplexity(t, p), rel_tol=1e-5) for i, t in enumerate(texts))


def test_kept_by_definition_and_again(docs_of, passages):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(passages(k % 9, 50).split()) for k in range(rng.randint(30, 200))), "en", "s") for i in range(150)]
    rows += [(200 + i, " ".join(w + "%%%" for w in passages(i, 60).split()), "en", "s") for i in range(4)]
    got = {r.doc_id: r for r in rules.rules(docs_of(rows, 2)).collect()}
    assert got == {r.doc_id: r for r in rules.rules(docs_of(rows, 7)).collect()}
    ok = [r for r in got.values() if not r.base_failed]
    at = lambda values, k: sorted(values)[-(-k * len(values) // 4) - 1]
    middle = at([r.log_perplexity for r in ok], 2)
    apart = [(r.log_perplexity - middle) * math.sqrt(r.n_words) for r in ok]
    low, high = abs(at(apart, 1)), abs(at(apart, 3))
    for r in got.values():
        d, root = r.log_perplexity - middle, math.sqrt(r.n_words)
        edge = max(rules.LEAST, rules.REACH * (high if d > 0 else low) / root)
        if abs(abs(d) - edge) > 0.1:
            assert r.kept == (not r.base_failed and abs(d) < edge)


def test_bands(docs_of):
    rng = random.Random(2)
    vowels, other = "aeiou", "qxzjkvwbpfhgmdcy#@~^{}[]é日本ж7"
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    texts = [" ".join(word(vowels) for _ in range(80)) for _ in range(150)] + [" ".join(word(other) for _ in range(80))] + ["too short", " ".join(["same words here"] * 40)]
    got = {r.doc_id: r for r in rules.rules(docs_of(texts)).collect()}
    assert all(got[i].kept for i in range(150)) and not got[150].kept and not got[150].base_failed
    assert got[151].base_failed and got[152].base_failed and not got[152].kept


def test_rules_on_odd_rows(odd, clashing, none):
    for df in (odd, clashing):
        out = rules.rules(df).collect()
        assert len(out) == odd.count() and all(r.base_failed for r in out if r.doc_id != 5)
    assert rules.rules(none).count() == 0
