"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the whole size; a target
stops at ``most`` times its source's size and the excess is shared again by weight. The total is cut into equal blocks
of ``block`` words; the blocks go to sources by highest quotients target / (2k + 1), and within a source the same way to
its shards, each of about ``per_shard`` words: an integer quota for each shard. In a shard the documents stand in a seeded
order, end to end, and so form the shard's blocks; the quota takes all of them as often as it can and then the first ones
of the seeded order, so a document at the end of a quota may be taken in part.

Nulls: a null text has size 0, a null source is a source of its own. Repeated rows are mixed as separate rows. Reruns
agree: order and shards depend on the seed and on the rows alone.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, stored

BLOCK = 32
PER_SHARD = 1 << 20
MOST = 3
SEED = 20240
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients votes / (2k + 1), the earlier one first where they are equal; no more than ``most`` each.

    Rounding at a common divisor comes within one seat for each party; a heap of quotients does the rest.
    """
    votes = np.asarray(votes, float)
    most = np.full(len(votes), np.iinfo(np.int64).max) if most is None else np.asarray(most, np.int64)
    most = np.where(votes > 0, most, 0)
    seats = int(min(seats, most.astype(float).sum()))
    if seats <= 0 or not len(votes):
        return np.zeros(len(votes), np.int64)
    at = lambda divisor: np.minimum(np.floor(votes / divisor + 0.5), most).astype(np.int64)
    low, high = 0.0, votes.sum() / seats + votes.max() * 2 + 1  # the divisor at high gives too few, at low too many
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (low, middle) if at(middle).sum() <= seats else (middle, high)
    won = at(high)
    heap = [(-votes[i] / (2 * won[i] + 1), i) for i in np.flatnonzero(won < most)]
    heapq.heapify(heap)
    for _ in range(seats - int(won.sum())):
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """sources (source, source_size), one row each, with target; windows over one row a source."""
    total = F.sum("source_size").over(W.partitionBy())
    df = sources.withColumn("_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    df = df.withColumn("_w", ((F.col("_rank") - 1) % 3 + 1).cast("double")).withColumn("_cap", (F.lit(most) * F.col("source_size")).cast("double"))
    before = W.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("_caps", F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).withColumn("_ws", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    df = df.withColumn("_level", (total - F.col("_caps")) / (F.sum("_w").over(W.partitionBy()) - F.col("_ws")))
    # sources in the order of cap / weight: those that the level passes are full; the first one it doesn't pass sets it
    df = df.withColumn("_full", F.col("_level") * F.col("_w") > F.col("_cap"))
    level = F.max(F.when(~F.col("_full"), F.struct(-(F.col("_cap") / F.col("_w")), -F.col("_rank"), F.col("_level").alias("level")))).over(W.partitionBy())
    return df.withColumn("_at", level["level"]).select("source", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * F.col("_at")).alias("target"))


def plan(docs: DataFrame, keep: tuple[str, ...] = (), block: int = BLOCK, per_shard: int = PER_SHARD, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row a document: doc_id, size, source_size, target (its source's), taken (words, repeats counted), then ``keep`` as _k_<name>."""
    extra = [F.col(f"`{c}`").alias(f"_k_{c}") for c in keep]
    # _key tells rows of one doc_id apart, and spreads those without one
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_key"), *extra)
    if not keep:
        sizes = stored(sizes, "sizes")
    sources = stored(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), most), "sources")

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last", key=lambda s: s.map(lambda x: x.encode("utf-8", "surrogatepass") if isinstance(x, str) else x))
        pdf["quota"] = sainte_lague(pdf["target"].to_numpy(), round(pdf["target"].sum() / block))
        return pdf

    # one row a source
    sources = sources.groupBy(F.lit("all")).applyInPandas(quotas, "source string, source_size long, target double, quota long")
    sources = stored(sources.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / per_shard))), "quotas")
    sharded = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    sharded = sharded.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.coalesce("doc_id", "_key")), F.col("n_shards")))

    def of_shards(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        words = pdf["words"].to_numpy()
        pdf["blocks"] = sainte_lague(words, int(pdf["quota"].iloc[0]), -(-most * words // block))
        return pdf[["source", "shard", "words", "blocks"]]

    # one row a shard: of a source, its words / per_shard rows
    shards = sharded.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
    shards = stored(shards.groupBy("source").applyInPandas(of_shards, "source string, shard long, words long, blocks long"), "shards")
    same = sharded["source"].eqNullSafe(shards["source"]) & (sharded["shard"] == shards["shard"])
    rows = sharded.join(shards, same).drop(shards["source"], shards["shard"])
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), F.coalesce("doc_id", "_key")), "doc_id", "size", "_key")
    rows = rows.withColumn("_end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
    wanted = F.least(F.col("blocks") * block, most * F.col("words"))
    rest = F.when(F.col("words") > 0, wanted % F.col("words")).otherwise(F.lit(0))
    passes = F.when(F.col("words") > 0, F.expr(f"least(blocks * {block}, {most} * words) div words")).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_end") - F.col("size"))))
    kept = [F.col(f"`_k_{c}`") for c in keep]
    return rows.select("doc_id", "size", "source_size", "target", (passes * F.col("size") + part).cast("long").alias("taken"), *kept)


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix has them: each whole copy is a row, and where a quota ends in a document its first words are one."""
    rows = plan(docs, keep=tuple(c for c in docs.columns if c != "doc_id"), **options).where("taken > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.expr("cast(ceil(taken / size) as int)"))))
    words = F.least(F.col("size"), F.col("taken") - (F.col("_copy") - 1) * F.col("size"))
    head = F.regexp_substr(F.col("_k_text"), F.concat(F.lit("^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){"), words.cast("string"), F.lit("}+")))
    whole = words == F.col("size")
    rows = rows.withColumn("_text", F.when(whole, F.col("_k_text")).otherwise(head)).withColumn("_whole", whole)
    out = {c: F.col(f"`_k_{c}`") for c in docs.columns if c != "doc_id"} | {"doc_id": F.col("doc_id"), "text": F.col("_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_whole"), F.col("_k_n_chars")).otherwise(F.length("_text"))
    return rows.select(*(out[c].alias(c) for c in docs.columns))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(documents(spark, sf_dir))


QUERIES = {"op10_mixing": op10_mixing}
ORACLES: dict[str, str] = {}
