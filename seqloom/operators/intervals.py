"""Interval joins, coverage, tiles and windows. Positions count from 1, ends are included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], bin_size: int, a_range: tuple[str, str] = ("start", "end"), b_range: tuple[str, str] = ("b_start", "b_end")) -> DataFrame:
    """Pairs of overlapping intervals with equal keys: an equi-join on bins of positions.

    Either side has a row for each bin that it touches; a pair counts in the bin of the later start only, so none comes
    twice and no distinct is needed. Choose bins about as wide as common intervals.
    """
    bins = lambda r: F.explode(F.sequence(F.floor(F.col(r[0]) / bin_size), F.floor(F.col(r[1]) / bin_size)))
    x = a.withColumn("_bin", bins(a_range))
    y = b.withColumn("_bin", bins(b_range))
    hit = (F.col(a_range[0]) <= F.col(b_range[1])) & (F.col(b_range[0]) <= F.col(a_range[1]))
    once = F.floor(F.greatest(a_range[0], b_range[0]) / bin_size) == F.col("_bin")
    return x.join(y, [*keys, "_bin"]).where(hit & once).drop("_bin")


def coverage(intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", weight: Column | None = None) -> DataFrame:
    """Runs (start, end, score) of equal coverage, by the sum of what opens and closes at each position.

    Work grows with the number of interval ends, not with their lengths.
    """
    w = F.lit(1).cast("long") if weight is None else weight
    edges = F.explode(F.array(F.struct(F.col(start).alias("pos"), w.alias("d")), F.struct((F.col(end) + 1).alias("pos"), (-w).alias("d"))))
    changes = intervals.select(*keys, edges.alias("e")).groupBy(*keys, F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    by = W.partitionBy(*keys).orderBy("pos")
    runs = changes.withColumn("score", F.sum("d").over(by.rowsBetween(W.unboundedPreceding, 0))).withColumn("end", F.lead("pos").over(by) - 1)
    return runs.where("score <> 0 and end is not null").select(*keys, F.col("pos").alias("start"), "end", F.col("score").cast("long").alias("score"))


def positions(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, pos, score) of every covered position."""
    return runs.select(*keys, F.explode(F.sequence("start", "end")).alias("pos"), "score")


def tiles(lengths: DataFrame, chromosome: str, length: str, size: int) -> DataFrame:
    """(chromosome, part, start, end) of the fixed-width tiles that cover each length."""
    parts = F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(length) / size).cast("long")))
    df = lengths.where(F.col(length) > 0).select(chromosome, length, parts.alias("part"))
    return df.select(chromosome, "part", ((F.col("part") - 1) * size + 1).alias("start"), F.least(F.col("part") * size, F.col(length)).alias("end"))


def dense_page(cover: DataFrame, tile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every position of the tiles with its score, zeros included."""
    every = tile.select(*keys, F.explode(F.sequence("start", "end")).alias("pos"))
    return every.join(cover.select(*keys, "pos", "score"), [*keys, "pos"], "left").fillna(0, ["score"])


def window_profile(cover: DataFrame, anchors: DataFrame, keys: Sequence[str], reach: int, size: int, length: str | None = None) -> DataFrame:
    """Sum of scores by distance from the anchors (pos - anchor), within ``reach``; windows that leave the range are dropped."""
    whole = anchors.where(F.col("anchor") - reach >= 1)
    if length:
        whole = whole.where(F.col("anchor") + reach <= F.col(length))
    around = whole.withColumn("w_start", F.col("anchor") - reach).withColumn("w_end", F.col("anchor") + reach)
    runs = cover.withColumn("p_start", F.col("pos")).withColumn("p_end", F.col("pos"))
    hits = overlap_join(around, runs, keys, size, ("w_start", "w_end"), ("p_start", "p_end"))
    return hits.groupBy((F.col("pos") - F.col("anchor")).alias("distance")).agg(F.sum("score").cast("long").alias("score"))
