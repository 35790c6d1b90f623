import os

import pytest

import corpus_pipeline as cp
from seqloom.llm.common import hashed_words, words_of

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns and docs.count() > 0.5 * n, name
    last = cp.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and "piece_ids" in last.columns
    assert sorted(map(repr, cp.run(spark, SF).collect())) == sorted(map(repr, last.collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_each_stage_against_brute_force(spark):
    """Each stage on what the one before kept, with what it must keep, cut or take found by plain loops."""
    from seqloom.llm import line_dedup
    from tests.llm import test_line_dedup, test_mixing, test_near_dedup

    rows = lambda df: {r.doc_id: r for r in df.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, kept = rows(docs), cp.stored(cp.quality(spark, docs, SF), "kept")
    after = rows(kept)
    assert all(before[i] == r for i, r in after.items())
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(i not in after for i in good) <= 0.02 * len(good)

    cut = cp.stored(cp.lines(spark, kept, SF), "cut")
    left = rows(cut)
    want = test_line_dedup.brute([(i, r.text) for i, r in after.items()])
    copies = {r.doc_id for r in line_dedup.line_dedup(kept).collect() if r.is_copy}
    for i, words in want.items():  # copies of a whole document are left to the next stage
        assert i in copies or (left[i].text.split() if i in left else []) == words

    alone = cp.stored(cp.near(spark, cut, SF), "alone")
    want = test_near_dedup.brute([(i, r.text) for i, r in left.items()], cp.SIMILARITY)
    single = rows(alone)
    assert set(single) == {i for i, (_, c) in want.items() if i == c} and all(left[i] == r for i, r in single.items())

    mixed = cp.stored(cp.mixed(spark, alone, SF), "mixed")
    sizes, taken = {}, {}
    for r in single.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(words_of(r.text))
    for r in mixed.collect():
        words = words_of(r.text)
        assert words == words_of(single[r.doc_id].text)[: len(words)]
        taken[r.source] = taken.get(r.source, 0) + len(words)
    for source, target in test_mixing.shares(sizes).items():
        assert abs(taken.get(source, 0) - target) <= test_mixing.op.BLOCK

    out = cp.encoded(spark, mixed, SF).collect()
    assert len(out) == mixed.count() and all(r.round_trip and r.n_pieces == len(r.piece_ids or ()) for r in out)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_odd_rows_pass_each_stage(spark, clashing, none):
    for df in (clashing, none):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            out.count()
        cp.STAGES[-1][1](spark, df, SF).count()


def test_the_last_stage_decodes_its_ids(spark, odd):
    from seqloom.llm import sentencepiece_codec as codec

    want = sorted(map(repr, codec.digest(odd).select("doc_id", "n_ids", "round_trip").collect()))
    got = cp.STAGES[-1][1](spark, odd, SF)
    assert sorted(map(repr, got.select("doc_id", got["n_pieces"].alias("n_ids"), "round_trip").collect())) == want


def test_hashed_words_are_the_words():
    seen = {}
    for text in ("", " a  b\tA\x1c b\n", "x" * 1_200_000 + " y " + "z" * 700_000, " ".join(map(str, range(200_000))), "É é 日本 x"):
        words, hashes = words_of(text), hashed_words(text)
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) and hashed_words("ABC é", fold=True).tolist() == hashed_words("abc é").tolist()
