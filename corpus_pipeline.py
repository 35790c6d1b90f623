"""The corpus pipeline: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. ``run``
writes each stage's rows as Parquet to the shared folder and reads them again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import line_dedup, mixing, near_dedup, quality_classifier, sentencepiece_codec
from seqloom.llm.common import TEXTS, documents, small_batches, stored

SIMILARITY = 80  # percent
#: Dropped ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Words that a Python worker of the last stage remembers: fewer than alone, since the stages before have filled the JVM.
REMEMBERED = 200_000


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns of these names renamed, and what they were called."""
    taken = {f"_own_{c}": c for c in docs.columns if c in names}
    for new, old in taken.items():
        docs = docs.withColumnRenamed(old, new)
    return docs, taken


def _columns_of(docs: DataFrame, rows: DataFrame, taken: dict[str, str]) -> DataFrame:
    back = {old: new for new, old in taken.items()}
    return rows.select(*(F.col(f"`{back.get(c, c)}`").alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    own, taken = _aside(docs, ("p_low", "p_toxic", "kept"))
    scored = quality_classifier.classify(own, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns_of(docs, scored.where("kept"), taken)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more go where they repeat later; a document goes when no word of it is left.

    Near copies of whole documents stay as they are: the next stage judges them.
    """
    small_batches(spark)
    own, taken = _aside(docs, ("n_cut", "is_copy"))
    done = line_dedup.line_dedup(own)
    return _columns_of(docs, done.where((F.col("n_cut") == 0) | F.col("text").rlike(mixing.WORD)), taken)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    gone = stored(near_dedup.near_duplicates(docs, SIMILARITY).where("not kept").select("doc_id").distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights: whole copies of documents, and the first words of those where a quota ends."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, piece_ids and round_trip (the ids decode to the text) of every copy."""
    small_batches(spark)
    rows = sentencepiece_codec.round_trips(docs.select("doc_id", "lang", "source", "text"), remember=REMEMBERED)
    return rows.select("doc_id", "lang", "source", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "piece_ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("mixing sources", mixed),
    ("SentencePiece encoding", encoded),
]

#: None of the stages can be said in SQL whole (trained models, seeded hashes); each is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower(), TEXTS)
    return STAGES[-1][1](spark, docs, sf_dir)
