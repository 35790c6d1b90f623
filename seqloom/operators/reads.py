"""Sequence reads: adapters, trimming, barcodes, demultiplexing, collapse."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions import strip_ends
from seqloom.operators.common import argmax, numbered

#: Adapters by name, in the order in which they are tried. Names and first letters of kit adapters.
ADAPTERS = {
    "Illumina Universal Adapter": "AGATCGGAAGAG",
    "Illumina Small RNA 3' Adapter": "TGGAATTCTCGG",
    "Illumina Small RNA 5' Adapter": "GATCGTCGGACT",
    "Nextera Transposase Sequence": "CTGTCTCTTATA",
    "SOLID Small RNA Adapter": "CGCCTTGGCCGT",
    "Ingolia 2012 adapter": "CTGTAGGCACCA",
    "Illumina Uni. Adapter var2": "ATCGTAGATCGG",
    "RiboLace adapter": "TCTCCTTGCATA",
    "polyA": "AAAAAAAAAA",
    "polyT": "TTTTTTTTTT",
    "polyN": "NNNNNNNNNN",
    "New CAC": "CACTCGGGCACC",
    "New GTG": "GTGTCAGTCACT",
    "New TGT": "TGTAGGCACCAT",
    "New TCG": "TCGTATGCCGTC",
}


def collapse(reads: DataFrame, seq: str = "seq", keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct sequences with their number; partial sums before the shuffle come with the aggregation."""
    return reads.groupBy(*keys, seq).agg(F.count("*").alias("n"))


def recollapse(parts: DataFrame, least: int = 20) -> DataFrame:
    """Partial collapses (seq, n) summed, numbered by n descending (ties by sequence), then short ones dropped.

    Numbers are given before the length filter, so they may have gaps.
    """
    total = parts.groupBy("seq").agg(F.sum("n").cast("long").alias("n"))
    rows = numbered(total, [F.col("n").desc(), F.col("seq")])
    return rows.where(F.length("seq") >= least).withColumn("header", F.concat(F.lit("seq"), F.col("number").cast("string"), F.lit("_x"), F.col("n").cast("string")))


def contains_counts(reads: DataFrame, candidates: dict[str, str], seq: str = "seq") -> DataFrame:
    """Reads that hold each candidate, in one pass."""
    hits = [F.count_if(F.contains(seq, F.lit(p))).alias(f"c{i}") for i, p in enumerate(candidates.values())]
    pairs = ", ".join(f"'{name.replace(chr(39), chr(92) + chr(39))}', c{i}" for i, name in enumerate(candidates))
    return reads.agg(*hits).selectExpr(f"stack({len(candidates)}, {pairs}) as (adapter, n_reads)")


def detect_adapter(reads: DataFrame, candidates: dict[str, str], seq: str = "seq") -> DataFrame:
    """The candidate in most reads; ties go to the first by name; ``disable`` when no read holds one."""
    best = argmax(contains_counts(reads, candidates, seq).withColumn("_g", F.lit(1)), ["_g"], "n_reads", "adapter").drop("_g")
    return best.withColumn("adapter", F.when(F.col("n_reads") > 0, F.col("adapter")).otherwise("disable"))


def adapter_content(reads: DataFrame, pattern: str, bin_size: int, seq: str = "seq") -> DataFrame:
    """Cumulative percentage of reads with the pattern at or before each position bin."""
    total = reads.agg(F.count("*").alias("total"))
    at = F.instr(F.col(seq), pattern)
    hits = reads.where(at > 0).groupBy(F.ceil(at / bin_size).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    run = F.sum("n").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))  # one row a bin
    return hits.crossJoin(total).select("bin", "n", F.round(100.0 * run / F.col("total"), 6).alias("cumulative_percent"))


def trim_at(seq: Column, hit: Column) -> Column:
    """What stands before the first hit; unchanged without one, empty when it is the first item."""
    return F.when(hit.isNull() | (hit <= 0), seq).when(hit == 1, "").otherwise(F.substring(seq, F.lit(1), hit - 1))


def trim_statistics(reads: DataFrame, original: str, trimmed: str) -> DataFrame:
    """One row: counts of trimmed, untouched, short, empty reads and lengths."""
    n = F.length(trimmed)
    return reads.agg(
        F.count("*").alias("reads"),
        F.count_if(F.length(original) != n).alias("trimmed"),
        F.round(100.0 * F.count_if(F.length(original) == n) / F.count("*"), 1).alias("percent_untouched"),
        F.count_if(n < 20).alias("below_20"),
        F.count_if(n == 0).alias("empty"),
        F.max(n).cast("long").alias("max_length"),
        F.round(F.avg(n), 6).alias("mean_length"),
        F.median(n).alias("median_length"),
    )


def polyn_trim(seq: Column, base: str, least: int = 10) -> Column:
    """Without a run of at least ``least`` of a base at the end."""
    return F.regexp_replace(seq, f"{base}{{{least},}}$", "")


def consensus(reads: DataFrame, first: int, share: float = 0.25, seq: str = "seq") -> DataFrame:
    """Letters of each of the first positions with a share of the reads or more, sorted and joined."""
    letters = reads.select(F.posexplode(F.split(F.substring(seq, 1, first), "")).alias("pos", "base")).where("base <> ''")
    n = letters.groupBy("pos", "base").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy("pos"))
    rows = n.withColumn("share", F.col("n") / total).where(F.col("share") >= share)
    return rows.groupBy((F.col("pos") + 1).cast("long").alias("pos")).agg(F.array_join(F.array_sort(F.collect_list("base")), "").alias("letters"))


def strip_umi(seq: Column, five: int, three: int) -> Column:
    return strip_ends(seq, five, three)


def demultiplex(reads: DataFrame, control: DataFrame, lane: str, barcode: str) -> DataFrame:
    """reads with their sample by (lane, barcode); unknown ones go to ``unmatched``. control is the sample sheet."""
    sheet = control.select(F.col("lane").alias(lane), F.col("barcode").alias(barcode), "sample")
    return reads.join(sheet, [lane, barcode], "left").withColumn("sample", F.coalesce("sample", F.lit("unmatched")))


def demultiplex_table(reads: DataFrame, control: DataFrame, lane: str, barcode: str) -> DataFrame:
    """Reads of every sample of the sheet (0 where none) and of ``unmatched``; they add up to all reads."""
    n = demultiplex(reads, control, lane, barcode).groupBy("sample").agg(F.count("*").alias("reads"))
    every = control.select("sample").distinct().unionByName(n.select("sample").where("sample = 'unmatched'"))
    return every.join(n, "sample", "left").fillna(0, ["reads"])


def change_point(curves: DataFrame, key: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """At most one change of the mean of each curve: the split with the least squared error (the first of ties).

    Cost of a split from running sums: sum(x^2) - S1^2/n1 - S2^2/n2. A curve of fewer than two points has none.
    """
    run = W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    all_ = W.partitionBy(key)
    s1, n1 = F.sum(value).over(run), F.count("*").over(run)
    s, n = F.sum(value).over(all_), F.count("*").over(all_)
    gain = s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1)
    rows = curves.withColumn("_gain", F.when(n > n1, F.round(gain, 9)))
    return rows.where("_gain is not null").groupBy(key).agg(F.min_by(F.col(pos), F.struct(-F.col("_gain"), F.col(pos))).alias("change_at"))


def barcode_sizes(votes: DataFrame, mean_length: float, max_before: int, cut_left: int, remain: int = 26) -> tuple[int, int]:
    """5' and 3' barcode sizes from the change points of all curves (a few rows: one a curve).

    5': the position below 18 with most votes, the largest of ties; 3': the one beyond max_before - cut_left with most, the
    smallest of ties; then 3' and 5' shrink until ``remain`` items are left.
    """
    rows = [r["change_at"] for r in votes.select("change_at").collect()]
    rows = [p for p in rows if p <= mean_length]
    count = {p: rows.count(p) for p in rows}
    five = max((p for p in count if p < 18), key=lambda p: (count[p], p), default=0)
    three = min((p for p in count if p > max_before - cut_left), key=lambda p: (-count[p], p), default=None)
    three = 0 if three is None else max(0, max_before - three - 2)
    left = mean_length - five - three
    cut = min(three, max(0, remain - left))
    three, left = int(three - cut), left + cut
    five = int(max(0, five - max(0, remain - left)))
    return five, three


#: Characters that ``approximate_first`` compares at a time; a longer read is one comparison of its own.
_AT_ONCE = 1 << 21


def approximate_first(batches: Iterator[pd.Series], pattern: str, most: int) -> Iterator[pd.Series]:
    """First full-length match with ``most`` substitutions at most (0: none). Reads lie end to end, some millions of
    characters at a time, and one comparison a letter of the pattern serves them all."""
    p = np.frombuffer(pattern.encode("utf-32-le"), np.uint32)

    def first(texts: list[str]) -> np.ndarray:
        n = np.array([len(t) for t in texts])
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.zeros(len(texts), np.int32)
        if len(x) < len(p):
            return out
        bad = np.zeros(len(x) - len(p) + 1, np.uint16)
        for k, c in enumerate(p):
            bad += x[k : k + len(bad)] != c
        hits = np.flatnonzero(bad <= most)
        of = np.searchsorted(begin, hits, "right") - 1  # reads of no length share their begin with the next one, which comes last
        inside = hits + len(p) <= begin[of] + n[of]
        hit_of, at = np.unique(of[inside], return_index=True)
        out[hit_of] = hits[inside][at] - begin[hit_of] + 1
        return out

    for batch in batches:
        texts = ["" if s is None else s for s in batch]
        parts, held, size = [], [], 0
        for t in texts:
            if held and size + len(t) > _AT_ONCE:
                parts.append(first(held))
                held, size = [], 0
            held.append(t)
            size += len(t)
        yield pd.Series(np.concatenate([*parts, first(held)]) if held else np.zeros(0, np.int32))


def approximate_first_udf(pattern: str, most: int):
    """``approximate_first`` as a vectorised function of a text column, for long reads in volume."""

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return approximate_first(batches, pattern, most)

    return run


def with_overrides(found: DataFrame, manual: DataFrame, key: str, column: str) -> DataFrame:
    """found with the manual table's value of a column where it has one."""
    table = manual.select(key, F.col(column).alias("_manual")).dropDuplicates([key])
    return found.join(table, key, "left").withColumn(column, F.coalesce("_manual", column)).drop("_manual")
