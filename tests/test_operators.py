import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import analysis, common, intervals, metadata, reads, records, runtime


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_recollapse_numbers_before_the_filter(spark):
    parts = spark.createDataFrame([("A" * 20, 3), ("A" * 20, 2), ("C" * 19, 9)], "seq string, n long")
    assert rows(reads.recollapse(parts).select("number", "seq", "n", "header")) == [(2, "A" * 20, 5, "seq2_x5")]


def test_collapse_conserves_reads(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([("".join(rng.choice("AC") for _ in range(3)),) for _ in range(500)], "seq string")
    assert reads.collapse(df).agg(F.sum("n")).first()[0] == 500


def test_trim(spark):
    df = spark.createDataFrame([("CCCCAGATC", 5), ("CCCC", None), ("AGATC", 1)], "s string, hit int")
    assert [r[0] for r in df.select(reads.trim_at(F.col("s"), F.col("hit"))).collect()] == ["CCCC", "CCCC", ""]


def test_demultiplex_conserves_reads(spark):
    r = spark.createDataFrame([("l1", "AA"), ("l1", "AC"), ("l2", "AA"), ("l1", "AA"), ("l1", None)], "lane string, bc string")
    sheet = spark.createDataFrame([("l1", "AA", "s1"), ("l2", "CC", "s2")], "lane string, barcode string, sample string")
    assert rows(reads.demultiplex_table(r, sheet, "lane", "bc")) == [("s1", 2), ("s2", 0), ("unmatched", 3)]


def test_matcher_is_the_expression(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("fast", reads.approximate_first_udf("ACGTA", 1)("s"))
    from seqloom.functions import approximate_positions

    got = df.select(F.coalesce("fast", F.lit(0)), F.coalesce(F.get(approximate_positions("s", "ACGTA", 1), F.lit(0)), F.lit(0))).collect()
    assert all(a == b for a, b in got) and any(a for a, _ in got)


def test_change_point(spark):
    df = spark.createDataFrame([("a", i, 1.0 if i <= 4 else 9.0) for i in range(1, 11)] + [("b", 1, 2.0)], "k string, pos int, value double")
    assert rows(reads.change_point(df, "k")) == [("a", 4)]


def test_barcode_sizes(spark):
    votes = spark.createDataFrame([(6,), (6,), (4,), (40,), (40,)], "change_at int")
    assert reads.barcode_sizes(votes, 45, 51, 15, 20) == (6, 9)
    assert reads.barcode_sizes(votes.limit(0), 45, 51, 15) == (0, 0)


def test_metadata_flags(spark):
    df = spark.createDataFrame([("p", "n", 1), ("p", "n", 2), ("q", "n", 3)], "k string, name string, pos int")
    assert rows(metadata.flag_repeats(df, ["k"], "name", [F.col("pos")]).select("pos", "not_unique")) == [(1, False), (2, True), (3, False)]


def test_replicates(spark):
    df = spark.createDataFrame([("s", "t", "", 1), ("s", "t", "", 2), ("u", "x", "3", 3)], "study string, title string, rep string, pos int")
    assert rows(metadata.renumber_replicates(df, "study", "title", "rep", [F.col("pos")]).select("pos", "rep")) == [(1, "1"), (2, "2"), (3, "3")]


def test_new_rows(spark):
    old = spark.createDataFrame([("a", "x", "p")], "s string, o string, b string")
    new = spark.createDataFrame([("a", "y", "p"), ("b", "x", "p"), ("a", "x", "q"), (None, "z", "z")], "s string, o string, b string")
    assert [r.s for r in common.new_by_keys(new, old, ["s", "o"], ["b", "o"]).collect()] == ["a", None]


def test_numbered_is_the_global_order(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(rng.randint(0, 50), i) for i in range(300)], "v int, i int")
    got = common.numbered(df, [F.col("v").desc(), F.col("i")]).orderBy("number").collect()
    assert [(r.v, r.i) for r in got] == sorted(((r.v, r.i) for r in got), key=lambda x: (-x[0], x[1])) and [r.number for r in got] == list(range(1, 301))
    assert common.numbered(df.limit(0), [F.col("i")]).count() == 0


def test_argmax_ties(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1)], "k string, item string, v int")
    assert common.argmax(df, ["k"], "v", "item").first().item == "x" and common.argmax(df, ["k"], "v", "item", last=True).first().item == "y"


def test_overlap_join_is_the_naive_join(spark):
    rng = random.Random(11)
    make = lambda n: [(rng.choice("ab"), s := rng.randint(1, 300), s + rng.randint(0, 90)) for _ in range(n)]
    a, b = make(120), make(120)
    x = spark.createDataFrame([(*r, i) for i, r in enumerate(a)], "chr string, start int, end int, i int")
    y = spark.createDataFrame([(*r, i) for i, r in enumerate(b)], "chr string, b_start int, b_end int, j int")
    want = sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if p[0] == q[0] and p[1] <= q[2] and q[1] <= p[2])
    assert rows(intervals.overlap_join(x, y, ["chr"], 40).select("i", "j")) == want


def test_coverage_runs(spark):
    df = spark.createDataFrame([("c", 1, 5), ("c", 3, 8), ("c", 9, 9)], "chr string, start int, end int")
    assert rows(intervals.coverage(df, ["chr"])) == [("c", 1, 2, 1), ("c", 3, 5, 2), ("c", 6, 9, 1)]


def test_tiles(spark):
    df = spark.createDataFrame([("c", 4500000), ("d", 0)], "chr string, n long")
    assert rows(intervals.tiles(df, "chr", "n", 2000000)) == [("c", 1, 1, 2000000), ("c", 2, 2000001, 4000000), ("c", 3, 4000001, 4500000)]


def test_alignment_metrics(spark):
    r = spark.createDataFrame([("a", 5), ("b", 2), ("c", 1)], "id string, w int")
    got = records.alignment_metrics(r, spark.createDataFrame([("a",), ("b",), ("b",)], "id string"), "id", "w").first().asDict()
    assert got == {"reads": 8, "sequences": 3, "aligned": 7, "aligned_sequences": 2, "alignments": 9, "alignment_rows": 3, "unique": 5, "unique_sequences": 1, "multi": 2, "multi_sequences": 1, "percent_aligned": 87.5}


def test_flags_and_junctions(spark):
    got = records.decode_flags(spark.createDataFrame([(0,), (4,), (256,), (2048,)], "flag int")).collect()
    assert [r.is_primary for r in got] == [True, False, False, False]
    j = records.decode_junctions(spark.createDataFrame([(2, 2), (1, 2), (2, 0)], "strand int, motif int")).collect()
    assert [tuple(r) for r in j] == [("-", "GT/AG"), ("+", "CT/AC"), ("-", "non-canonical")]


def test_frames_and_verdict(spark):
    df = spark.createDataFrame([("l", 28, 0, 70), ("l", 28, 1, 20), ("l", 28, 2, 10)], "lib string, len int, fr int, s int")
    t = records.frame_table(df, "lib", F.col("len"), F.col("fr"), F.col("s"))
    assert [(r.frame, r.percent_length, r.best_frame) for r in t.orderBy("frame").collect()] == [(0, 70.0, True), (1, 20.0, False), (2, 10.0, False)]
    assert records.periodicity_verdict(t, "lib").first().verdict == "warning" and records.periodicity_verdict(t, "lib", empty_is_good=True).first().verdict == "good"


def test_shift_fallback(spark):
    level = lambda *x: spark.createDataFrame(x, "lib string, fraction int, offsets_start int")
    got = records.shift_fallback(level(("a", 28, -12)), level(("a", 29, -11), ("b", 30, -13)))
    assert rows(got.select("lib", "fraction", "level")) == [("a", 28, 1), ("b", 30, 2)]


def test_progress_and_eligibility(spark):
    steps = runtime.step_table(spark, ["s1", "s2", "s3", "s4", "s5"])
    units = spark.createDataFrame([("u",), ("v",), ("w",)], "unit string")
    flags = spark.createDataFrame([("u", s) for s in ("s1", "s2", "s4")] + [("v", f"s{i}") for i in range(1, 6)], "unit string, step string")
    t = runtime.status(units, steps, flags)
    assert rows(runtime.progress(t)) == [("u", 2, False), ("v", 5, True), ("w", 0, False)]
    assert rows(runtime.eligible(t)) == [("u", 3, "s3"), ("w", 1, "s1")]
    assert rows(runtime.current_steps(t)) == [("done", 1), ("s1", 1), ("s3", 1)]
    assert rows(runtime.reset_from(flags, steps, "s4").where("unit = 'v'")) == [("s1", "v"), ("s2", "v"), ("s3", "v")]


def test_steps_and_registry(spark):
    assert len(runtime.steps_for("Ribo-seq")) == 14 and runtime.steps_for("Ribo-seq", contaminants=True).index("contam") == 4
    assert "fetch" not in runtime.steps_for("RNA-seq", local=True)
    r = runtime.StepRegistry()
    r.register("x")(lambda df: df.where("id > 1"))
    assert r.run(spark.range(4)).count() == 2
    with pytest.raises(ValueError):
        r.register("x")(lambda df: df)


def test_retry_and_fallback():
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return 7

    assert runtime.retry(flaky, wait=0) == 7 and runtime.first_success(lambda: 1 / 0, lambda: 5) == (2, 5)


def test_dead_letters(spark):
    good, dead = runtime.split_valid(spark.createDataFrame([(1,), (-1,), (None,)], "x int"), {"positive": F.col("x") > 0})
    assert good.count() == 1 and [r.errors for r in dead.collect()] == [["positive"]] * 2


def test_contrasts(spark):
    df = spark.createDataFrame([("WT",), ("KO",), ("KO",)], "c string")
    assert rows(analysis.contrast_pairs(df, "c", ["WT", "ctrl"])) == [("KO", "WT")]


def test_set_checks(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    assert tuple(common.same_set(a, b, "k").first()) == (1, 0, False)


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 5)], "a int, b int, c int")
    assert common.drop_null_columns(df).columns == ["a", "c"] and common.drop_constant_columns(df.select("a", "c")).columns == ["a"]


def test_shift_editor(spark):
    t = records.template_shifts(spark.createDataFrame([("a",), ("b",)], "lib string"), range(28, 30))
    assert rows(records.edit_shifts(t, -1, ["a"], [28])) == [("a", 28, -13), ("a", 29, -12), ("b", 28, -12), ("b", 29, -12)]
    with pytest.raises(Exception, match="above 0"):
        records.edit_shifts(t, 20).collect()


def test_flags_sessions_and_steps(spark):
    units = spark.createDataFrame([("u",)], "unit string")
    flags = runtime.set_flags(spark.createDataFrame([("u", "x")], "unit string, step string"), units, ["x", "y"], ["x", "y"])
    assert rows(flags) == [("u", "x"), ("u", "y")]
    with pytest.raises(ValueError):
        runtime.set_flags(flags, units, ["z"], ["x"])
    assert runtime.add_step(["a"], "b") == ["a", "b"] and runtime.add_step(["a"], "b", "head") == ["b", "a"]
    s = runtime.sessions_active(spark.createDataFrame([(1,), (2,)], "pgid int"), spark.createDataFrame([(2,), (2,)], "pgid int"))
    assert rows(s) == [(1, False), (2, True)]
    u = spark.sql("select 'u' unit, timestamp'2024-01-01 00:00:00' ts")
    assert rows(runtime.still_progressing(u, "unit", "ts", F.lit("2024-01-01 02:30:00").cast("timestamp"), 2)) == [("u", 2.5, False)]


def test_blacklist_and_keep(spark):
    ids, bad = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("c",)], "id string")
    assert metadata.check_blacklist(ids, bad).count() == 2
    with pytest.raises(Exception, match="blacklist"):
        metadata.check_blacklist(ids, ids).collect()
    df = spark.createDataFrame([(True, "RFP"), (True, "RNA"), (None, "RFP"), (False, "RFP")], "KEEP boolean, LIBRARYTYPE string")
    assert [x.count() for x in metadata.keep_split(df, ["RFP"])] == [1, 1]


def test_overrides_and_labels(spark):
    found = spark.createDataFrame([("r1", "AG"), ("r2", "CT")], "Run string, adapter string")
    assert rows(reads.with_overrides(found, spark.createDataFrame([("r2", "GG")], "Run string, adapter string"), "Run", "adapter")) == [("r1", "AG"), ("r2", "GG")]
    df = spark.createDataFrame([("Liver ",), ("",), (None,)], "tissue string").withColumns(analysis.filled_labels("tissue"))
    assert rows(df) == [("liver",), ("unknown",), ("unknown",)]
    logs = analysis.log_normalised(spark.createDataFrame([("f", "l", 1), ("g", "l", 1)], "feature string, lib string, count int"), per=2).first()
    assert logs.count_log == 1.0
