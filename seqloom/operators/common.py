"""Helpers of the operators: schemas, numbering, first rows, argmax with ties."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns: missing ones null, others dropped, types cast."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def union_fill(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an explicit order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share; it goes when the session ends.

    Where that setting is missing (single-machine tests) it is set to a new local folder.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        top = tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/seqloom/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """df with _part and _row: rows dealt by range, the partition's number and the row's place in it.

    The frame is written once and read back. A range repartition draws a sample for its bounds each time it runs, so
    sizes counted by a second run would belong to other partitions.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", place)
    rows = rows.withColumns({"_part": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_place")
    path, schema = shared_dir(spark, "dealt"), rows.schema
    rows.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _before(parts: DataFrame, value: Column) -> DataFrame:
    """(_part, _start): the value summed over the partitions before; one row a partition, so small enough for one task."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = parts.groupBy("_part").agg(value.alias("_sum"))
    return sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number") -> DataFrame:
    """df with consecutive numbers from 1 in a total order, without one task that holds all rows.

    Rows are dealt by range into a fixed number of partitions and numbered there; the sizes of the partitions before give
    the offsets.
    """
    rows = _dealt(df, order)
    starts = _before(rows, F.count("*"))
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_row") + 1).drop("_part", "_row", "_start")


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """df with the sum of a column over the rows up to each one in a total order; dealt as in ``numbered``."""
    rows = _dealt(df, order)
    starts = _before(rows, F.sum(value))
    here = F.sum(value).over(W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn(name, here).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col(name)).drop("_part", "_row", "_start")


def drop_null_columns(df: DataFrame, forced: Sequence[str] = ()) -> DataFrame:
    """Without the columns that are null throughout, but for the forced ones. One pass of counts."""
    counts = df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns)).first()
    return df.select(*(c for c in df.columns if counts[c] or c in forced))


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold one value (nulls aside) throughout. One pass of minima and maxima."""
    bounds = df.agg(*(F.min(c).alias(f"a{i}") for i, c in enumerate(df.columns)), *(F.max(c).alias(f"b{i}") for i, c in enumerate(df.columns))).first()
    return df.select(*(c for i, c in enumerate(df.columns) if bounds[f"a{i}"] != bounds[f"b{i}"]))


def add_if_absent(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns({k: v for k, v in columns.items() if k not in df.columns})


def argmax(df: DataFrame, keys: Sequence[str], value: str, item: str, last: bool = False) -> DataFrame:
    """The item with the largest value of each key; of ties the smallest item, or the largest if ``last``. No shuffle of rows
    beyond the partial maxima."""
    best = F.max_by(F.col(item), F.struct(F.col(value), F.col(item))) if last else F.min_by(F.col(item), F.struct(-F.col(value), F.col(item)))
    return df.groupBy(*keys).agg(best.alias(item), F.max(value).alias(value))


def ordered_lookup(probe: DataFrame, build: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Left join that keeps the probe's rows once: the first match of each key in the build's order."""
    return probe.join(first_per_key(build, [key], order), key, "left")


def new_by_keys(batch: DataFrame, existing: DataFrame, *key_sets: Sequence[str]) -> DataFrame:
    """Rows of the batch that no key set finds among the existing ones (null keys match nothing)."""
    for keys in key_sets:
        batch = batch.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return batch


def contains_join(texts: DataFrame, text: Column, pieces: DataFrame, piece: str) -> DataFrame:
    """Pairs of a row and each piece that its text holds (an empty piece is in every text, a null in none).

    An equi-join: texts are cut into substrings of the pieces' lengths, so work grows with the texts and not with the
    number of pieces. Lengths in use are few; a text's distinct substrings of one length are found once.
    """
    table = pieces.withColumn("_n", F.length(piece))
    lengths = F.broadcast(table.agg(F.array_sort(F.collect_set("_n")).alias("_lengths")))  # one row
    cut = lambda n: F.when(n == 0, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(1), F.length("_text") - n + 1), lambda i: F.substring("_text", i, n)))
    fitting = F.filter("_lengths", lambda n: n <= F.length("_text"))
    found = F.explode(F.array_distinct(F.flatten(F.transform(fitting, cut))))
    rows = texts.withColumn("_text", text).crossJoin(lengths).withColumn(piece, found).drop("_text", "_lengths")
    return rows.join(table.drop("_n"), piece)


def same_set(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: only_a, only_b, and whether the two sets of keys are equal."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    both = x.withColumn("_a", F.lit(1)).join(y.withColumn("_b", F.lit(1)), key, "full")
    only = both.agg(F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))
    return only.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))
