"""Contrasts, peaks and stable identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import half_even, url_safe_digest


def contrast_pairs(df: DataFrame, condition: str, controls: Sequence[str]) -> DataFrame:
    """Unordered pairs (a, b) of the distinct conditions; a control stands second. Distinct conditions are few."""
    x = df.select(condition).distinct()
    pairs = x.select(F.col(condition).alias("x")).join(x.select(F.col(condition).alias("y")), F.col("x") < F.col("y"))
    swap = F.col("x").isin(*controls)
    return pairs.select(F.when(swap, F.col("y")).otherwise(F.col("x")).alias("a"), F.when(swap, F.col("x")).otherwise(F.col("y")).alias("b"))


def contrast_summary(df: DataFrame, contrast: str, regulation: str) -> DataFrame:
    return df.groupBy(contrast, regulation).agg(F.count("*").alias("n"))


def groups_above(df: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """Rows of the groups with more than ``least`` rows."""
    return df.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).where(F.col("_n") > least).drop("_n")


def block_text(blocks: Column) -> Column:
    """start-end;start-end of an array of (start, end) blocks, in order."""
    return F.array_join(F.transform(F.array_sort(blocks), lambda b: F.concat_ws("-", b["start"].cast("string"), b["end"].cast("string"))), ";")


def width(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda acc, b: acc + b["end"] - b["start"] + 1)


def length_bucket(n: Column) -> Column:
    """L and the rounded decimal logarithm of a width; an error for widths that are not positive."""
    return F.when(n > 0, F.concat(F.lit("L"), half_even(F.log10(n)).cast("int").cast("string"))).otherwise(F.raise_error(F.lit("width must be positive")))


def region_id(blocks: Column, assembly: str, chromosome: Column, strand: Column, digest_length: int = 10) -> Column:
    """Readable, stable identifier of an interval list: assembly, place, length bucket, strand and the begin of a digest of
    the blocks alone."""
    digest = F.substring(url_safe_digest(block_text(blocks)), 1, digest_length)
    return F.concat_ws(":", F.lit("TRN"), F.lit(assembly), chromosome, length_bucket(width(blocks)), strand, digest)


def machine_id(text: Column) -> Column:
    """Identifier by the whole digest of a canonical text."""
    return F.concat(F.lit("TRN:V1:sha512t24u:"), url_safe_digest(text))


def log_normalised(counts: DataFrame, lib: str = "lib", value: str = "count", per: float = 1e6) -> DataFrame:
    """counts (feature, lib, count) with ``value_log``: log2(1 + counts per million of the library)."""
    total = F.sum(value).over(W.partitionBy(lib))
    return counts.withColumn(f"{value}_log", F.when(total > 0, F.log2(1 + per * F.col(value) / total)))


def filled_labels(*columns: str) -> dict[str, Column]:
    """Label columns in lower case, empty and null ones as unknown."""
    return {c: F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown")) for c in columns}
