"""Sessions of the pipeline, pools of samples from a FASTQ stream, and curation."""

import pytest
from pyspark.sql import functions as F

from seqloom import streaming
from seqloom.operators import demultiplexing, metadata, runner
from seqloom.operators.common import contains_join


def test_sessions_isolate_errors_and_go_on(spark, tmp_path):
    project, calls, broken = runner.Project(spark, str(tmp_path / "project")), [], {"b"}

    def fetch(spark, unit):
        calls.append(("fetch", unit))

    def trim(spark, unit):
        calls.append(("trim", unit))
        if unit in broken:
            raise RuntimeError(f"no reads in {unit}")

    steps = {"fetch": fetch, "trim": trim, "align": lambda spark, unit: calls.append(("align", unit))}
    assert runner.run(project, ["a", "b", "c"], steps) == 1
    assert ("align", "a") in calls and ("align", "b") not in calls and len(calls) == 8
    error = project.session_errors().collect()
    assert [(r.unit, r.step, r.message) for r in error] == [("b", "trim", "RuntimeError: no reads in b")]
    assert project.session_errors(pattern="disk").count() == 0
    broken.clear()
    calls.clear()
    assert runner.run(project, ["a", "b", "c"], steps) == 2 and calls == [("trim", "b"), ("align", "b")]
    got = {r.session: (r.status, r.units) for r in project.sessions().collect()}
    assert got == {1: ("Failed", 3), 2: ("Completed", 3)}
    assert [(r.session, r.errors) for r in project.error_counts().collect()] == [(2, 0), (1, 1)]
    units = spark.createDataFrame([("a",), ("b",), ("d",)], "unit string")
    rows = {r.unit: (r.progress_index, r.finished, r.failed_step) for r in runner.report(project, units, list(steps)).collect()}
    assert rows == {"a": (3, True, None), "b": (3, True, None), "d": (0, False, None)}


def test_groups_of_steps():
    assert runner.group_steps(["a", "b", "c", "d"], {"x": ["b", "d"]}) == {"a": ["a"], "x": ["b", "d"], "c": ["c"]}
    with pytest.raises(ValueError):
        runner.group_steps(["a"], {"x": ["b"]})


def test_pools_from_a_stream(spark, tmp_path):
    control = spark.createDataFrame([("L1", "AAC", "s1", "p"), ("L1", "GGT", "s2", "p"), ("L2", "AAC", "s3", "q")], "lane string, barcode string, sample string, final_sample string")
    insert = "ACGTACGTACGTACGTACGTAC"
    read = lambda bar, adapter="AGATCGGAAGAG": f"TTTT{insert}CCCCC{bar}{adapter}GGG"
    for k, seqs in enumerate(([read("AAC"), read("GGT"), read("CCC"), insert], [read("AAC", "AGATCGCAAGAG"), "AGATCGGAAGAG"])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.fastq").write_text("".join(f"@r{k}{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(seqs)))
    found = []

    def put(batch, number):
        done = demultiplexing.assign(batch.withColumn("lane", F.lit("L1")), control, "AGATCGGAAGAG").cache()
        demultiplexing.write_samples(done, str(tmp_path / "samples"))
        demultiplexing.collapsed(done, control).write.mode("overwrite").parquet(f"{tmp_path}/parts/batch={number}")
        found.append(number)

    stream = streaming.fastq_source(spark, str(tmp_path / "in"))
    stream.writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    assert len(found) == 2
    assert {r["sample"]: r["count"] for r in spark.read.parquet(str(tmp_path / "samples")).groupBy("sample").count().collect()} == {"s1": 2, "s2": 1}
    rows = demultiplexing.sample_reads(spark.read.parquet(str(tmp_path / "parts")), "p").collect()
    assert [(r.seq, r.n, r.header) for r in rows] == [(insert, 3, "seq1_x3")]
    done = demultiplexing.assign(spark.createDataFrame([("L2", read("AAC"))], "lane string, seq string"), control, "AGATCGGAAGAG")
    assert {r["sample"]: r.n_reads for r in demultiplexing.counts(done, control).collect()} == {"s1": 0, "s2": 0, "s3": 1}


@pytest.mark.parametrize("rows", [[], [("L", "AA", "s"), ("L", "A", "t")], [("L", "AA", "s"), ("L", "AA", "t")], [("L", "AA", "s"), ("M", "AA", "s")], [(None, "AA", "s")]])
def test_control_tables_are_checked(spark, rows):
    with pytest.raises(ValueError):
        demultiplexing.check_control(spark.createDataFrame(rows, "lane string, barcode string, sample string"))


def test_curation(spark):
    table = spark.createDataFrame([("r1", "old", True), ("r2", "old", None)], "Run string, LIBRARYTYPE string, KEEP boolean")
    curated = spark.createDataFrame([("r2", "RFP", True, "x"), ("r3", "RFP", True, "x")], "Run string, LIBRARYTYPE string, KEEP boolean, TISSUE string")
    merged = metadata.merged_curation(curated, table)
    assert sorted((r.Run, r.LIBRARYTYPE, r.TISSUE) for r in merged.collect()) == [("r1", "old", None), ("r2", "RFP", "x"), ("r3", "RFP", "x")]
    bad = lambda df: metadata.invalid_rows(df, ["TISSUE"], ["LIBRARYTYPE", "TISSUE"], [F.col("Run")], ["RFP"])
    assert sorted((r.Run, r.reasons) for r in bad(merged).collect()) == [("r1", ["library type"]), ("r3", ["name"])]
    versions = iter([merged, merged.where("Run = 'r2'")])
    assert metadata.curation_loop(lambda: next(versions), bad)[0]
    assert not metadata.curation_loop(lambda: merged, bad, rounds=2)[0]


def test_contains_join(spark):
    texts = spark.createDataFrame([(1, "banana"), (2, ""), (3, None), (4, "an")], "i int, t string")
    pieces = spark.createDataFrame([("an",), ("banana",), ("",), (None,), ("x",)], "p string")
    got = sorted((r.i, r.p) for r in contains_join(texts, F.col("t"), pieces, "p").collect())
    assert got == [(1, ""), (1, "an"), (1, "banana"), (2, ""), (4, ""), (4, "an")]
