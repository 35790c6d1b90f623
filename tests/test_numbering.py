"""Global numbers and running totals of frames with many rows in one input partition."""

import random

import pytest
from pyspark.sql import functions as F

from seqloom.functions import approximate_positions
from seqloom.operators import reads
from seqloom.operators.common import numbered, running_total


@pytest.mark.parametrize("rows", [0, 1, 1300, 5000, 50_000])
def test_numbers_are_row_numbers(spark, rows):
    df = spark.range(rows).coalesce(1).select("id", (F.xxhash64("id") % 100).alias("k"))
    got = numbered(df, [F.desc("k"), F.col("id")]).collect()
    want = sorted(((r["k"], r["id"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert sorted((r["number"], r["k"], r["id"]) for r in got) == [(i, *r) for i, r in enumerate(want, 1)]


def test_running_total(spark):
    df = spark.range(5000).coalesce(1).select("id", (F.pmod(F.xxhash64("id"), F.lit(50))).alias("v"))
    got = {r["id"]: r["used"] for r in running_total(df, [F.col("v"), F.col("id")], "v", "used").collect()}
    total = 0
    for v, i in sorted((r["v"], r["id"]) for r in df.collect()):
        total += v
        assert got[i] == total


def test_matchers_agree_with_brute_force(spark):
    rng = random.Random(5)
    texts = ["", None, "acg", "acgta", "xacgta😀cgtaacgta", "aaaaaaaaaa", "\n\n", "(.+)acgtA"]
    texts += ["".join(rng.choice("acgt😀") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    for pattern, most in (("acgta", 1), ("aaa", 0), ("cgtacg", 2), ("(.+)", 1)):
        hits = lambda s, p=pattern, m=most: [i + 1 for i in range(len(s) - len(p) + 1) if sum(a != b for a, b in zip(s[i:], p)) <= m]
        rows = df.select("i", approximate_positions("s", pattern, most).alias("at"), reads.approximate_first_udf(pattern, most)("s").alias("one")).collect()
        for r in rows:
            want = hits(texts[r["i"]] or "")
            assert r["at"] == (None if texts[r["i"]] is None else want) and r["one"] == (want[0] if want else 0)
