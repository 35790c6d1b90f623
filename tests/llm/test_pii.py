import random
import re

from pyspark.sql import functions as F

from seqloom.llm import pii as op

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind in op.KINDS:
        for m in re.finditer(BASE[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 13 <= len(d) <= 19 and op.luhn_python(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


def spans(x):
    return [(s.kind, s.start, s.end) for s in x]


def test_base_spans(docs_of):
    rng = random.Random(1)
    bits = ["1", "25", ".", "+", "(", ")", " ", "-", "a", "@", "b.c", ".com", "4111 1111 1111 1111", "192.168.0.1", "é", "😀", "_", "300", "\n", "x@y.z", "+1 (415) 555-0100", "0001.2.3.4"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    for r in op.find(docs_of(texts)).collect():
        assert spans(r.base) == brute(r.text), r.text
        assert set(spans(r.base)) <= set(spans(r.spans)) and all(r.text[s.start : s.end] == s.value for s in r.spans)
        assert spans(r.spans) == sorted(spans(r.spans), key=lambda s: (op.KINDS.index(s[0]), s[1], s[2]))


def test_very_long_runs_are_linear(docs_of):
    texts = ["1" * 200_000, "a." * 60_000 + "@" + "b." * 60_000 + "c", "+1" + "(" * 100_000, "1 " * 60_000, "%" * 100_000, "1." * 60_000]
    for r in op.find(docs_of(texts)).collect():
        want = brute(r.text) if r.text[0] != "1" or "." in r.text else []
        assert spans(r.base) == want


def test_added_spans(docs_of):
    texts = ["call (212) 555-0123 now", "write to jo (at) mail [dot] com", "card 4111/1111/1111/1111 is", "order no 123-456-7890-11", "ip 2001:db8:1:2:3:4:5:6 up", "at 12:30:45:10:11:12 o'clock", "nothing 2023-10-24 here"]
    got = {r.doc_id: [s.value for s in r.spans] for r in op.find(docs_of(texts)).collect()}
    assert got == {0: ["(212) 555-0123"], 1: ["jo (at) mail [dot] com"], 2: ["4111/1111/1111/1111"], 3: [], 4: ["2001:db8:1:2:3:4:5:6"], 5: [], 6: []}


def test_trees_on_unseen_spans():
    trees, thresholds = op.trained()
    spans_ = op.training_spans(1000, 99)
    x, y = op._matrix(spans_)
    score = op.RATE * sum(op._value(t, x) for t in trees)
    chosen = [s >= thresholds[kind] for s, (kind, *_) in zip(score, spans_, strict=True)]
    hits = sum(bool(c and t) for c, t in zip(chosen, y, strict=True))
    assert hits / max(1, sum(chosen)) > 0.97 and hits / y.sum() > 0.9


def test_scores_are_the_same_in_spark(spark):
    trees, _ = op.trained()
    rows = op.training_spans(200, 5)
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(rows)], "i int, kind string, v string, b string, a string")
    x, _ = op._matrix([(k, v, b, a[:1], y) for k, v, b, a, y in rows])
    want = op.RATE * sum(op._value(t, x) for t in trees)
    for kind in op.KINDS:
        got = df.where(F.col("kind") == kind).select("i", op.scored(kind, F.col("v"), F.col("b"), F.substring("a", 1, 1), trees).alias("s")).collect()
        assert got and all(abs(r.s - want[r.i]) < 1e-9 for r in got)


def test_redact(docs_of):
    assert op.redact(docs_of(["mail x@y.de or +49 (30) 1234-5678, ok", "clean"])).orderBy("doc_id").first().text == "mail [EMAIL] or [PHONE], ok"


def test_odd_rows(odd, clashing, none):
    for df in (odd, clashing):
        out = op.find(df).collect()
        assert len(out) == odd.count() and all(r.base == [] for r in out)
        assert op.redact(df).count() == len(out)
    assert op.find(none).count() == 0


def test_no_python_on_the_main_path(odd):
    plan = op.find(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_secrets_and_cards_beside_each_other(docs_of):
    cards = "7536784127813050 4111111111111111"
    texts = ['x token = "908038b7daaf91e730d2f64001c52934d43d9336" y', "commit 908038b7daaf91e730d2f64001c52934d43d9336 y", f"pay {cards} now", "see section-alpha-v2-draft-index-page here", "TOKEN = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\"!!"]
    got = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in op.find(docs_of(texts)).collect()}
    assert got[0] == [("secret", "908038b7daaf91e730d2f64001c52934d43d9336")] and got[4] == [("secret", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B")]
    assert got[1] == got[3] == [] and got[2] == [("card", c) for c in cards.split() if op.luhn_python(c)]


def test_query_against_brute_force_on_tables(spark):
    """Base columns by plain matching; what the trees add, on texts that their training never saw."""
    import hashlib
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op.op7_pii(spark, sf).collect():
        base = brute(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in op.KINDS] == [sum(b[0] == k for b in base) for k in op.KINDS]
        said = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        every = [x for x in r.spans.split(",") if x]
        assert set(said) <= set(every) and r.n_found == len(every) + len([x for x in r.secrets.split(",") if x])
        for x in set(every) - set(said):  # added: a card whose digits pass, beside another number
            kind, a, b = x.split(":")
            assert kind == "card" and op.luhn_python(re.sub("[^0-9]", "", texts[r.doc_id][int(a) : int(b)]))
        planted = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', texts[r.doc_id])}
        assert planted == {x for x in r.secrets.split(",") if x}
    clean = spark.read.parquet(f"{sf}/benchmark.parquet").select("text").unionByName(spark.read.parquet(f"{sf}/conversations.parquet").select("text"))
    assert op.find(clean).where("size(spans) > size(base)").count() == 0
