"""Checks of files, BAM input, polled streams."""

import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from seqloom import sources, streaming
from seqloom.operators import files, runtime
from seqloom.sources.bam import bam


def block(data: bytes) -> bytes:
    """One block of the packed form: a gzip member with its size in an extra field."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25)
    return head[:9] + b"\xff" + head[10:] + body + struct.pack("<II", zlib.crc32(data), len(data))


def bam_record(name, flag, ref, pos, mapq, ops, seq, tags):
    codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    cigar = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in ops)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, mapq, 0, len(ops), flag, len(seq), -1, -1, 0)
    body += name.encode() + b"\0" + cigar + packed + b"\xff" * len(seq) + tags
    return struct.pack("<i", len(body)) + body


@pytest.fixture
def bams(tmp_path):
    refs = b"".join(struct.pack("<i", 5) + n + b"\0" + struct.pack("<i", 1000) for n in (b"chr1", b"chr2"))
    data = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2) + refs
    tags = b"XZZtext\0" + b"XBBs" + struct.pack("<Ihh", 2, 1, 2) + b"XAAq" + b"XFf" + struct.pack("<f", 1.5) + b"NHC\x03" + b"NMs" + struct.pack("<h", -2)
    rows = [("r1", 0, 0, 5, 60, [(3, "S"), (4, "M")], "ACGTNAC", tags), ("r2", 16, 1, 900, 0, [(4, "M")], "ACGT", b""), ("r3", 4, -1, 0, 0, [], "", b"NHi" + struct.pack("<i", 70000))]
    rows += [(f"x{i}", 0, 0, i + 1, 1, [(40, "M")], "ACGT" * 10, b"NHC\x01") for i in range(3000)]
    data += b"".join(bam_record(*r) for r in rows)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.bam").write_bytes(b"".join(block(data[i : i + 5000]) for i in range(0, len(data), 5000)) + block(b""))
    return tmp_path / "b"


def test_bam(spark, bams):
    got = bam(spark, str(bams))
    first = {r.qname: tuple(r)[2:] for r in got.where("qname like 'r%'").collect()}
    assert first == {
        "r1": (0, "chr1", 5, 60, "3S4M", "ACGTNAC", 3, None, -2, None),
        "r2": (16, "chr2", 900, 0, "4M", "ACGT", None, None, None, None),
        "r3": (4, "*", 0, 0, "*", "*", 70000, None, None, None),
    }
    x = got.where("qname like 'x%'").agg(F.count("*"), F.sum("pos"), F.min("seq"), F.sum("NH")).first()
    assert tuple(x) == (3000, 3000 * 3001 // 2, "ACGT" * 10, 3000)
    assert bam(spark, str(bams), mapped_only=True).count() == 3002


def test_bam_that_is_cut_is_an_error(spark, bams):
    whole = (bams / "one.bam").read_bytes()
    (bams / "one.bam").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="within a record"):
        bam(spark, str(bams)).count()


def test_fastq_verdicts(spark):
    runs = spark.createDataFrame([("a", False), ("b", True), ("c", False), ("d", True), ("e", False), ("f", True), ("g", False)], "run string, paired boolean")
    names = {"a": ["a.fastq.gz", "a.fastq"], "b": ["b_1.fastq.gz", "b_2.fastq.gz"], "c": ["c.fastq.gz", "c_1.fastq.gz"], "d": ["d.fastq.gz"], "e": ["e_1.fastq.gz", "e_2.fastq.gz", "e.fastq.gz"], "f": ["f.txt"]}
    found = spark.createDataFrame([(r, n) for r, ns in names.items() for n in ns], "run string, name string")
    got = {r.run: (r.verdict, r.keep, r.remove) for r in files.fastq_verdicts(runs, found).collect()}
    assert got == {
        "a": ("ok", ["a.fastq.gz"], ["a.fastq"]),
        "b": ("ok", ["b_1.fastq.gz", "b_2.fastq.gz"], []),
        "c": ("ok", ["c.fastq.gz"], ["c_1.fastq.gz"]),
        "d": ("layout", ["d.fastq.gz"], []),
        "e": ("invalid", [], ["e.fastq.gz", "e_1.fastq.gz", "e_2.fastq.gz"]),
        "f": ("missing", [], []),
        "g": ("missing", [], []),
    }


def test_first_data_line(spark, tmp_path):
    (tmp_path / "a.gtf").write_text("#x\n#y\nchr1\n#z\n")
    assert [r.line for r in files.first_data_line(sources.lines(spark, str(tmp_path / "a.gtf"))).collect()] == [3]
    (tmp_path / "b.gtf").write_text("#x\n")
    with pytest.raises(Exception, match="only comments"):
        files.first_data_line(sources.lines(spark, str(tmp_path / "b.gtf"))).collect()


def test_tracks(spark):
    s = spark.createDataFrame([("x", 2), ("y", 1)], "folder string, i int")
    there = spark.createDataFrame([("x/pshifted_merged/RFP.ofst",)], "path string")
    assert [(r.path, r.rep) for r in files.track_paths(s, ["RFP"], "folder", [F.col("i")]).orderBy("rep").collect()] == [("y/pshifted_merged/RFP.ofst", 1), ("x/pshifted_merged/RFP.ofst", 2)]
    with pytest.raises(Exception, match="no track y"):
        files.track_paths(s, ["RFP"], "folder", [F.col("i")], there).collect()
    with pytest.raises(ValueError):
        files.track_paths(s, ["RFP", "RNA"], "folder", [F.col("i")])


def test_report_without_valid_runs_takes_all(spark):
    a = spark.createDataFrame([("trimmed_r1", 2_000_000_000)], "sample string, mapped long")
    t = spark.createDataFrame([("r1", 4_000_000_000, 3_000_000_000, 30)], "raw_library string, raw_reads long, trim_reads long, trim_mean_length int")
    totals, lengths = files.run_report(a, t, spark.createDataFrame([("other",)], "run string"))
    assert totals.first().asDict() == {"samples": 1, "mapped": 2.0, "raw": 4.0, "trimmed": 3.0} and lengths.first().percent == 100.0


def test_control_sheet(spark):
    good = spark.createDataFrame([(1, "AA", "s"), (1, "CC", "t")], "LANE int, BARCODE string, sample string")
    assert files.control_problems(good, 1).count() == 0
    assert [r.problem for r in files.control_problems(good.unionAll(good), 0).collect()] == ["repeated sample", "no files"]
    with pytest.raises(ValueError):
        files.control_problems(good.drop("LANE"), 1)


def test_flags_and_retries(spark):
    flags = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "unit string, step string")
    a = flags.where("unit = 'a'")
    assert sorted(map(tuple, runtime.remove_flags(flags, a, ["x"], ["x", "y"]).collect())) == [("a", "y"), ("b", "x")]
    assert runtime.remove_flags(flags, a, ["all"], ["x", "y"]).count() == 1
    with pytest.raises(ValueError):
        runtime.remove_flags(flags, a, ["z"], ["x"])
    calls = []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert runtime.retry(action, wait=0.001, spread=1.0) == "done" and len(calls) == 3


def test_polling_takes_what_comes_later(spark, tmp_path):
    seen, folder = [], str(tmp_path / "in")
    spark.range(3).write.parquet(folder)
    stream = streaming.source(spark, folder, spark.range(1).schema, files_a_batch=100)
    query = streaming.polled(stream, lambda batch, n: seen.append(batch.count()), str(tmp_path / "c"), 0.2)
    try:
        for more in (False, True):
            if more:
                spark.range(3, 8).write.mode("append").parquet(folder)
            end = time.time() + 60
            while sum(seen) < (8 if more else 3) and time.time() < end:
                time.sleep(0.1)
        query.processAllAvailable()
        progress = streaming.batch_progress(query, spark).agg(F.sum("rows")).first()[0]
    finally:
        query.stop()
    assert sum(seen) == 8 and progress == 8
