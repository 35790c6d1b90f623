"""Exact dedup with a cuckoo-filter index over text digests.

Texts are equal when they are identical after lower-casing A-Z. The digest is the SHA-256 of the lower-cased text.
Each partition of the index owns the digests that hash to it: a cuckoo filter answers "new" without a look at the
stored keys; a hit is verified against the bucketed keys (whole digest and byte length); an overflow doubles the
filter and fills it again from the stored keys. Before the shuffle each task folds its repeats, so a text that
a third of all rows share reaches its partition as a few rows a task.

Nulls: a null text counts as empty, a null doc_id is kept as a row (it never wins over a number).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, documents, parts_for, stored

#: Distinct digests that one partition of the index holds at most, on average (about 200 bytes each in Python).
PER_PART = 500_000
SLOTS, KICKS = 4, 200


class CuckooIndex:
    """Live digests: a cuckoo filter (4 slots a bucket, 16-bit fingerprints) in front of bucketed content.

    An entry is [digest, n_bytes, keep_id, n]: n live rows, the largest id seen among them.
    """

    def __init__(self, buckets: int = 1024):
        self.size = 0
        self.resizes = 0
        self._new(max(2, 1 << (buckets - 1).bit_length()))

    def _new(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))
        self.content: list[list | None] = [None] * buckets

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(digest[:8], "little")
        print_ = (h >> 48) or 1
        first = h & self.mask
        return print_, first, first ^ (print_ * 0x5BD1E995 & self.mask)

    def _put(self, print_: int, at: int) -> bool:
        """Puts a fingerprint into bucket ``at`` or kicks others on; False when there is no room."""
        slots, mask = self.slots, self.mask
        moved = []
        for kick in range(KICKS):
            for bucket in (at, at ^ (print_ * 0x5BD1E995 & mask)):
                for k in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                    if not slots[k]:
                        slots[k] = print_
                        return True
            k = at * SLOTS + (kick + print_) % SLOTS
            moved.append((k, slots[k]))
            print_, slots[k] = slots[k], print_
            at ^= print_ * 0x5BD1E995 & mask
        for k, old in reversed(moved):
            slots[k] = old
        return False

    def _grow(self) -> None:
        """Doubles the filter until every stored key has a place."""
        entries, buckets = list(self), (self.mask + 1) * 2
        while True:
            self._new(buckets)
            self.resizes += 1
            for entry in entries:
                print_, first, _ = self._places(entry[0])
                if not self._put(print_, first):
                    break
                self._store(first, entry)
            else:
                return
            buckets *= 2

    def _store(self, bucket: int, entry: list) -> None:
        if self.content[bucket] is None:
            self.content[bucket] = [entry]
        else:
            self.content[bucket].append(entry)

    def __iter__(self) -> Iterator[list]:
        return (e for bucket in self.content if bucket for e in bucket)

    def __len__(self) -> int:
        return self.size

    def may_contain(self, digest: bytes) -> bool:
        """The filter's answer alone: False is certain, True may be wrong."""
        print_, first, second = self._places(digest)
        slots = self.slots
        return print_ in slots[first * SLOTS : first * SLOTS + SLOTS] or print_ in slots[second * SLOTS : second * SLOTS + SLOTS]

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        """The live entry of a digest: the filter first, then the stored keys of its bucket."""
        if self.may_contain(digest):
            for entry in self.content[self._places(digest)[1]] or ():
                if entry[0] == digest and entry[1] == n_bytes:
                    return entry
        return None

    def insert(self, digest: bytes, n_bytes: int, keep_id: int | None, n: int = 1) -> bool:
        """Adds n rows of a digest; True if it was new."""
        if entry := self.find(digest, n_bytes):
            entry[3] += n
            if keep_id is not None and (entry[2] is None or keep_id > entry[2]):
                entry[2] = keep_id
            return False
        entry = [digest, n_bytes, keep_id, n]
        print_, first, _ = self._places(digest)
        while not self._put(print_, first):
            self._grow()
            print_, first, _ = self._places(digest)
        self._store(first, entry)
        self.size += 1
        return True

    def delete(self, digest: bytes, n_bytes: int, n: int = 1) -> bool:
        """Takes n rows of a digest away; with the last one its fingerprint and key go. False if it isn't live."""
        entry = self.find(digest, n_bytes)
        if entry is None:
            return False
        entry[3] -= n
        if entry[3] <= 0:
            print_, first, second = self._places(digest)
            self.content[first].remove(entry)
            for k in (*range(first * SLOTS, first * SLOTS + SLOTS), *range(second * SLOTS, second * SLOTS + SLOTS)):
                if self.slots[k] == print_:
                    self.slots[k] = 0
                    break
            self.size -= 1
        return True


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest binary, n_bytes) of every row."""
    text = ascii_lower(F.col(text_col))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def _folded(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeats within a task's batch become one row."""
    for pdf in batches:
        pdf["op"] = pdf["op"].astype("int8")
        out = pdf.groupby(["digest", "n_bytes", "op"], sort=False, as_index=False)["doc_id"].agg(["max", "size"])
        yield out.rename(columns={"max": "keep_id", "size": "n"})[["digest", "n_bytes", "op", "keep_id", "n"]]


def _indexed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partition of the index: inserts (op 0), then deletions (op 1)."""
    index, touched = CuckooIndex(), set()
    for pdf in batches:
        ids = pdf["keep_id"].astype("object").where(pdf["keep_id"].notna(), None)
        for digest, n_bytes, op, keep, n in zip(pdf["digest"], pdf["n_bytes"], pdf["op"], ids, pdf["n"], strict=True):
            digest = bytes(digest)
            if op == 0:
                index.insert(digest, n_bytes, None if keep is None else int(keep), n)
            else:
                index.delete(digest, n_bytes, n)
                touched.add(digest)
    chunk = []
    for entry in index:
        chunk.append((*entry, entry[0] in touched))
        if len(chunk) == 20_000:
            yield _frame(chunk)
            chunk = []
    if chunk:
        yield _frame(chunk)


def _frame(rows: list) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=["digest", "n_bytes", "keep_id", "group_size", "touched"])
    pdf["keep_id"] = pdf["keep_id"].astype("Int64")
    return pdf


def build_index(members: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """(digest, n_bytes, keep_id, group_size, touched) of the live digests.

    members, removed: (doc_id, digest, n_bytes), rows to insert and rows to delete afterwards. touched: a deletion met
    the digest, so its keep_id may be of a deleted row (``dedup`` asks the live rows then).
    """
    spark = members.sparkSession
    rows = members.withColumn("op", F.lit(0))
    if removed is not None:
        rows = rows.unionByName(removed.withColumn("op", F.lit(1)))
    folded = rows.select("digest", "n_bytes", "op", "doc_id").mapInPandas(_folded, "digest binary, n_bytes long, op byte, keep_id long, n long")
    dealt = folded.repartition(parts_for(members.count(), PER_PART, spark), "digest")
    if removed is not None:
        dealt = dealt.sortWithinPartitions("op")
    return dealt.mapInPandas(_indexed, "digest binary, n_bytes long, keep_id long, group_size long, touched boolean")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: DataFrame | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; rows that share the largest id, text and all, are repeats
    of one document and are all marked kept. removed: rows (same columns) that leave the collection: their digests are
    deleted from the index, and they are absent from the result.
    """
    members = stored(digests(docs, id_col, text_col), "digests")
    live = members
    if removed is not None:
        removed = stored(digests(removed, id_col, text_col).join(members, ["doc_id", "digest", "n_bytes"], "left_semi"), "removed")
        live = members.join(removed, ["doc_id", "digest", "n_bytes"], "left_anti")
    index = stored(build_index(members, removed), "index")
    if removed is not None:  # a deleted row may have been the one to stay
        again = live.join(index.where("touched").select("digest", "n_bytes"), ["digest", "n_bytes"], "left_semi")
        again = again.groupBy("digest", "n_bytes").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        index = index.where("not touched").drop("touched").unionByName(again)
    # the rows' side is skewed where many share a text; adaptive execution splits it, the index side is unique
    joined = live.join(index.select("digest", "n_bytes", "keep_id", "group_size"), ["digest", "n_bytes"])
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir))


QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLES = {
    "op1_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
}
