import os

import duckdb
import pytest

from seqloom.llm import licenses as op

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_against_exact_containment(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = sorted(duckdb.sql(op.ORACLES["op2_license_scan"]).select("doc_id, license, containment, first_word").fetchall())
    assert want and sorted(map(tuple, op.op2_license_scan(spark, SF).select("doc_id", "license", "containment", "first_word").collect())) == want


def test_templates_in_text(docs_of, passages):
    docs = docs_of([passages(1, 90) + " " + op.TEMPLATES["mit"].upper() + " " + passages(2, 50), passages(3, 200), "all rights  Reserved!", op.TEMPLATES["apache-2.0"].replace("compliance", "accord")])
    got = {(r.doc_id, r.license): r for r in op.scan(docs).collect()}
    assert got[0, "mit"].containment == 1 and got[0, "mit"].first_word == 90 and got[2, "all-rights-reserved"].first_word == 0
    assert 0.8 <= got[3, "apache-2.0"].containment < 1 and not any(i == 1 for i, _ in got)


def test_odd_rows(odd, clashing, none):
    assert op.scan(odd).count() == op.scan(clashing).count() == op.scan(none).count() == 0


def test_hits_in_odd_rows(docs_of, passages):
    """Repeated rows, a null doc_id, a very long text, ties of windows and clashing columns."""
    from pyspark.sql import functions as F

    mit, long = op.TEMPLATES["mit"], passages(4, 40_000)
    rows = [(1, mit, "en", "a"), (1, mit, "en", "a"), (None, mit, "en", "a"), (2, f"{long} {mit} {long}", None, None), (3, f"{mit} x {mit}", "en", "a"), (4, None, "en", "a"), (5, "", "en", "a")]
    docs = docs_of(rows).withColumns({c: F.lit(7) for c in ("k", "window", "bands", "license", "_text", "_words", "_group", "_start")})
    got = {r.doc_id: (r.license, r.containment, r.first_word) for r in op.scan(docs).collect() if r.license == "mit"}
    assert got == {1: ("mit", 1, 0), None: ("mit", 1, 0), 2: ("mit", 1, 40_000), 3: ("mit", 1, 0)}


def test_screen_loses_nothing():
    for k, _, found in op.groups(op.TEMPLATES):
        for words in found.values():
            shingles, must = op.shingles_of(words, k), op.screen_words(words, k)
            assert sum(not any(w in s.split() for w in must) for s in shingles) / len(shingles) < op.CONTAINED
