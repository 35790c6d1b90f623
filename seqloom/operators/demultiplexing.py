"""Pools of samples taken apart: the barcode stands before the adapter, between molecular tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import approximate_positions, strip_ends
from seqloom.operators.reads import collapse, recollapse


def check_control(control: DataFrame) -> int:
    """The barcodes' length of a control table (lane, barcode, sample); an error where it isn't usable."""
    r = control.agg(
        F.count("*").alias("n"), F.count_distinct("sample").alias("samples"), F.count_distinct("lane", "barcode").alias("pairs"),
        F.min(F.length("barcode")).alias("least"), F.max(F.length("barcode")).alias("most"), F.count_if(F.expr("lane is null or barcode is null or sample is null or barcode = ''")).alias("empty"),
    ).first()
    wrong = {"no rows": r["n"] == 0, "empty fields": r["empty"] > 0, "samples repeat": r["samples"] < r["n"], "barcodes repeat in a lane": r["pairs"] < r["n"], "barcodes differ in length": r["least"] != r["most"]}
    if found := [k for k, v in wrong.items() if v]:
        raise ValueError(f"control table: {', '.join(found)}")
    return r["most"]


def assign(reads: DataFrame, control: DataFrame, adapter: str, five: int = 4, three: int = 5, least: int = 19, mismatches: int = 2) -> DataFrame:
    """reads (lane, seq) with barcode, sample and insert; null where the adapter isn't found, sample null for unknown barcodes.

    The adapter must leave room before it for the shortest insert, both tags and the barcode. The insert is what stands
    before the barcode, without ``five`` letters at its begin and ``three`` at its end. The control table is a sample sheet, so
    it is broadcast.
    """
    size = check_control(control)
    hit = F.get(approximate_positions("seq", adapter, mismatches, least + five + three + size), F.lit(0))
    before = F.substring("seq", F.lit(1), F.col("_hit") - 1)
    rows = reads.withColumn("_hit", hit).withColumn("_before", before)
    insert = strip_ends(F.substring("_before", F.lit(1), F.length("_before") - size), five, three)
    rows = rows.withColumns({"barcode": F.right("_before", F.lit(size)), "insert": F.when(F.col("_hit").isNotNull(), insert)}).drop("_hit", "_before")
    return rows.join(F.broadcast(control.select("lane", "barcode", "sample")), ["lane", "barcode"], "left")


def collapsed(assigned: DataFrame, control: DataFrame) -> DataFrame:
    """(sample, seq, n) of the inserts; lanes of one pooled sample (final_sample of the control table, where it has one) add up."""
    found = assigned.where("sample is not null")
    if "final_sample" in control.columns:
        found = found.join(F.broadcast(control.select("sample", "final_sample")), "sample").drop("sample").withColumnRenamed("final_sample", "sample")
    return collapse(found.select("sample", F.col("insert").alias("seq")), keys=("sample",))


def counts(assigned: DataFrame, control: DataFrame) -> DataFrame:
    """The control table with the number of reads of each barcode."""
    n = assigned.where("sample is not null").groupBy("sample").agg(F.count("*").alias("n_reads"))
    return control.join(n, "sample", "left").fillna(0, ["n_reads"])


def write_samples(reads: DataFrame, path: str, mode: str = "append") -> None:
    """Reads as one folder a sample; batches of a stream append to it."""
    reads.where("sample is not null").write.mode(mode).partitionBy("sample").parquet(path)


def sample_reads(parts: DataFrame, sample: str) -> DataFrame:
    """One sample's partial collapses (sample, seq, n), summed, numbered and without the short ones."""
    return recollapse(parts.where(F.col("sample") == sample).select("seq", "n"))
