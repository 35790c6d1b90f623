"""Alignment and junction records: flags, metrics, merged and collapsed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import has_bit, percent

#: Bits of the SAM flag; fixed values of the format.
UNMAPPED, SECONDARY, SUPPLEMENTARY = 0x4, 0x100, 0x800
#: Labels of junction motifs 0 to 6; fixed values of the aligner's table.
MOTIFS = ("non-canonical", "GT/AG", "CT/AC", "GC/AG", "CT/GC", "AT/AC", "GT/AT")


def decode_flags(df: DataFrame, flag: str = "flag") -> DataFrame:
    unmapped, secondary, supplementary = (has_bit(flag, b) for b in (UNMAPPED, SECONDARY, SUPPLEMENTARY))
    return df.withColumns({"is_unmapped": unmapped, "is_secondary": secondary, "is_supplementary": supplementary, "is_primary": ~(unmapped | secondary | supplementary)})


def decode_junctions(df: DataFrame, strand: str = "strand", motif: str = "motif") -> DataFrame:
    """strand 0, 1, 2 as *, +, -; on - the motifs 2, 4 and 6 are named as seen from the other strand."""
    s = F.when(F.col(strand) == 1, "+").when(F.col(strand) == 2, "-").otherwise("*")
    m = F.col(motif)
    turned = F.when((F.col(strand) == 2) & m.isin(2, 4, 6), m - 1).otherwise(m)
    names = F.array(*map(F.lit, MOTIFS))
    return df.withColumn(motif, F.get(names, turned.cast("int"))).withColumn(strand, s)


def alignment_metrics(reads: DataFrame, alignments: DataFrame, key: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Totals of reads and of their alignments. reads: one row a sequence with its multiplicity; alignments: one row each."""
    n = alignments.groupBy(key).agg(F.count("*").alias("_n"))
    x = reads.join(n, key, "full").withColumns({"_n": F.coalesce("_n", F.lit(0)), "_w": F.coalesce(weight, F.lit(0))})
    some, one, many = F.col("_n") > 0, F.col("_n") == 1, F.col("_n") > 1
    total = lambda cond, v: F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("long")
    w = F.col("_w")
    out = x.groupBy(*by).agg(
        F.sum(w).cast("long").alias("reads"), F.count("*").alias("sequences"), total(some, w).alias("aligned"), F.count_if(some).alias("aligned_sequences"),
        F.sum(w * F.col("_n")).cast("long").alias("alignments"), F.sum("_n").cast("long").alias("alignment_rows"), total(one, w).alias("unique"), F.count_if(one).alias("unique_sequences"),
        total(many, w).alias("multi"), F.count_if(many).alias("multi_sequences"),
    )
    return out.withColumn("percent_aligned", percent(F.col("aligned"), F.col("reads"), 2))


def merge_records(df: DataFrame, keys: Sequence[str], weight: Column) -> DataFrame:
    """Equal records summed."""
    return df.groupBy(*keys).agg(F.sum(weight).cast("long").alias("score"))


def psite_shift(records: DataFrame, shifts: DataFrame, lib: str, length: str, start: str) -> DataFrame:
    """Starts moved by the offset of (library, read length); lengths without one are dropped."""
    table = shifts.select(F.col("lib").alias(lib), F.col("fraction").alias(length), "offsets_start")
    return records.join(table, [lib, length]).withColumn(start, F.col(start) - F.col("offsets_start"))


def shift_fallback(*levels: DataFrame) -> DataFrame:
    """The first level that has offsets for a library wins as a whole; level counts from 1."""
    every = None
    for i, df in enumerate(levels, 1):
        x = df.withColumn("level", F.lit(i))
        every = x if every is None else every.unionByName(x)
    best = every.groupBy("lib").agg(F.min("level").alias("level"))
    return every.join(best, ["lib", "level"])


def frame_table(df: DataFrame, lib: str, length: Column, frame: Column, score: Column) -> DataFrame:
    """Scores by library, length and frame, with percentages and the best frame of each length."""
    from pyspark.sql import Window as W

    g = df.groupBy(F.col(lib), length.alias("length"), frame.alias("frame")).agg(F.sum(score).alias("score"))
    by_lib, by_length = W.partitionBy(lib), W.partitionBy(lib, "length")
    g = g.withColumn("percent", F.round(100.0 * F.col("score") / F.sum("score").over(by_lib), 6))
    share = F.col("score") / F.sum("score").over(by_length)
    return g.withColumn("percent_length", F.round(100.0 * share, 6)).withColumn("best_frame", F.col("score") == F.max("score").over(by_length))


def periodicity_verdict(frames: DataFrame, lib: str, least: float = 25.0, empty_is_good: bool = False) -> DataFrame:
    """good or warning: frame 0 isn't best in some length and weak there. No such length is a warning too unless told so."""
    bad = (F.col("frame") == 0) & ~F.col("best_frame")
    none = F.count_if(bad) == 0
    warn = F.bool_or(bad & (F.col("percent_length") < least)) | (F.lit(False) if empty_is_good else none)
    return frames.groupBy(lib).agg(F.when(warn, "warning").otherwise("good").alias("verdict"), F.count_if(bad).alias("bad_lengths"))


def template_shifts(libraries: DataFrame, lengths: range, offset: int = -12) -> DataFrame:
    """The same offset for every read length of every library (lib)."""
    return libraries.select("lib").distinct().select("lib", F.explode(F.array(*map(F.lit, lengths))).alias("fraction"), F.lit(offset).alias("offsets_start"))


def edit_shifts(shifts: DataFrame, delta: int, libraries: Sequence[str] | None = None, lengths: Sequence[int] | None = None) -> DataFrame:
    """Offsets moved by delta where library and length are among the given ones (None: all); an error for offsets above 0."""
    hit = F.lit(True)
    if libraries is not None:
        hit &= F.col("lib").isin(*libraries)
    if lengths is not None:
        hit &= F.col("fraction").isin(*lengths)
    moved = F.when(hit, F.col("offsets_start") + delta).otherwise(F.col("offsets_start"))
    return shifts.withColumn("offsets_start", F.when(moved > 0, F.raise_error(F.lit("an offset would be above 0")).cast("int")).otherwise(moved))
