import base64
import hashlib

from pyspark.sql import functions as F

from seqloom import functions as f
from seqloom.operators import analysis


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first().asDict()


def test_text_helpers(spark):
    row = one(
        spark, pasted=f.paste("_", F.lit("a"), F.lit(None).cast("string"), F.lit(3)), first=f.sub_first(F.lit("aXbX"), "X", "-"),
        stripped=f.strip_ends(F.lit("AAAACCCCGGGGG"), 4, 5), nothing=f.strip_ends(F.lit("ACGT"), 4, 5), sub=f.subseq_safe(F.lit("ACGTACGT"), -3, 4), empty=f.subseq_safe(F.lit("ACGT"), 4, 2),
        base=f.basename(F.lit("a/b/c.fq.gz")), up=f.dirname(F.lit("a/b/c.fq.gz")), ext=f.extension(F.lit("a/b/c.fq.gz")), title=f.sentence_case(F.lit("hOMO Sapiens")),
    )
    assert row == {"pasted": "a_NA_3", "first": "a-bX", "stripped": "CCCC", "nothing": "", "sub": "ACGT", "empty": "", "base": "c.fq.gz", "up": "a/b", "ext": "gz", "title": "Homo sapiens"}


def test_rounding_and_digits(spark):
    row = one(spark, a=f.half_even(F.lit(0.5)), b=f.half_even(F.lit(2.5)), d=f.digit_total(F.lit(105)), p=f.percent(F.lit(1), F.lit(0)), fin=f.finite(F.lit(float("inf"))))
    assert row == {"a": 0.0, "b": 2.0, "d": sum(len(str(i)) for i in range(1, 106)), "p": None, "fin": False}


def test_approximate_positions(spark):
    rows = [("CCCCAGATCGGTTGAGXX",), ("AGATC",), ("",), ("AGATCGGAAGAGAGATCGGAAGAG",)]
    got = spark.createDataFrame(rows, "s string").select(f.approximate_positions("s", "AGATCGGAAGAG", 2).alias("p")).collect()
    assert [r.p for r in got] == [[5], [], [], [1, 13]]


def test_codons_and_bits(spark):
    row = one(spark, c=f.codons(F.lit("ACGTA\nC")), none=f.codons(F.lit("AC")), bit=f.has_bit(F.lit(260), 256), tile=f.position_bucket(F.lit(2000001), 2000000))
    assert row == {"c": ["ACG", "TA\n"], "none": [], "bit": True, "tile": 2}


def test_region_id_is_pinned(spark):
    df = spark.createDataFrame([([(101240000, 101240962), (101231230, 101231500)],)], "b array<struct<start:bigint,end:bigint>>")
    got = df.select(analysis.region_id(F.col("b"), "GRCh38", F.lit("chr22"), F.lit("+"))).first()[0]
    digest = base64.urlsafe_b64encode(hashlib.sha512(b"101231230-101231500;101240000-101240962").digest()[:24]).decode()
    assert got == f"TRN:GRCh38:chr22:L3:+:{digest[:10]}"
    assert one(spark, m=analysis.machine_id(F.lit("101231230-101231500;101240000-101240962")))["m"] == f"TRN:V1:sha512t24u:{digest}"
    buckets = spark.createDataFrame([(31,), (32,), (1234,)], "n int").select(analysis.length_bucket(F.col("n")).alias("b")).collect()
    assert [r.b for r in buckets] == ["L1", "L2", "L3"]
