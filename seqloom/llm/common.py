"""Shared helpers of the training-data operators: words, hashes and tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` has a fast way for plain ASCII, where it does the same."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of anything but space and U+0009 to U+000D, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """As ``words_of``, with A-Z in lower case (bytes.lower leaves other letters alone)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.Generator(np.random.PCG64(3)).integers(1, 1 << 64, 256, dtype=np.uint64)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
#: Bytes of a text that are hashed at a time; longer texts are cut at white space.
_AT_ONCE = 1 << 19
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n powers of the base and of its inverse (modulo 2**64); made once a worker, longer as needed."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(max(n, 1 << 15), base, np.uint64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def hashed_words(text: str | None, fold: bool = False) -> np.ndarray:
    """64-bit hashes of a text's words (runs of anything but space and U+0009 to U+000D), in order; fold: A-Z as a-z.

    No word becomes a Python object: the hashes are differences of one cumulated sum over the text's bytes.
    """
    parts = [_hashed(p, fold)[0] for p in pieces((text or "").encode("utf-8", "surrogatepass"))]
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``_AT_ONCE`` bytes, cut at white space; longer where there is none. Nothing for an empty text."""
    at = 0
    while at < len(data):
        end = at + _AT_ONCE
        if end < len(data):  # up to the next white space, so no word is cut
            later = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, min(len(data) - end, _AT_ONCE), end)])
            while not len(later) and end + _AT_ONCE < len(data):
                end += _AT_ONCE
                later = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, min(len(data) - end, _AT_ONCE), end)])
            end = end + int(later[0]) if len(later) else len(data)
        yield data[at:end]
        at = end


def word_groups(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(number of its text, hash, begin and end of each word, the bytes that these are places of) of some hundred KB at a time.

    A longer text comes in several groups.
    """
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def made() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
        data = b" ".join(held)
        words, begin, end = _hashed(data, False)
        count = np.diff(np.searchsorted(begin, np.cumsum([len(p) + 1 for p in held])), prepend=0)
        return np.repeat(np.array(rows), count), words, begin, end, data

    for i, text in enumerate(texts):
        for piece in pieces((text or "").encode("utf-8", "surrogatepass")):
            if held and size + len(piece) > _AT_ONCE:
                yield made()
                held, rows, size = [], [], 0
            held.append(piece)
            rows.append(i)
            size += len(piece)
    if held:
        yield made()


def hashed_texts(texts: Sequence[str | None], fold: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes of all words, number of words of each) of groups of neighbouring texts.

    Some hundred KB are hashed at a time; a longer text is a group of its own.
    """
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(data) > _AT_ONCE:
            yield i - len(held), *_group(held, fold)
            held, size = [], 0
        held.append(data)
        size += len(data)
    if held:
        yield len(texts) - len(held), *_group(held, fold)


def _group(texts: list[bytes], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    if len(texts) == 1:
        words = hashed_words(texts[0].decode("utf-8", "surrogatepass"), fold)
        return words, np.array([len(words)])
    words, begin, _ = _hashed(b" ".join(texts), fold)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(begin, ends), prepend=0)


def _hashed(data: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, begins and ends of the words."""
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    edge = np.empty(len(b) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    begin, end = at[::2], at[1::2]
    up, down = powers(len(b))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(np.take(_FOLDED if fold else _BYTES, b) * up, out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin, end


_CACHES: dict[str, dict] = {}


def released() -> None:
    """Memory that this process has freed goes back to the system, as far as its allocators can give it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def worker_cache(owner: str) -> dict:
    """A dict that lives in the Python worker between tasks of one operator.

    When a worker turns to another operator the others' dicts are emptied and unused memory goes back to the system.
    """
    if owner not in _CACHES:
        _CACHES.clear()
        gc.collect()
        released()
    return _CACHES.setdefault(owner, {})


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive items; of the whole sequence where it has fewer than n; empty for none."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out) + hashes[k : len(hashes) - n + 1 + k]
    return mixed(out + np.uint64(n))


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


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a Python worker's batch where they hold texts, and where they hold numbers alone.
TEXTS, NUMBERS = 1_000, 10_000


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Python workers get TEXTS rows in a batch: for results that are made lazily.

    The usual 10,000 rows of long texts take hundreds of MB in a worker.
    """
    spark.conf.set(_BATCH, str(TEXTS))


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it holds, Python workers get at most this many rows in a batch."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def map_batches(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: T.StructType | str) -> DataFrame:
    """``mapInPandas`` for columns of any name: Spark itself takes a dot in a name for a field of a struct."""
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInPandas(lambda batches: run(pdf.set_axis(names, axis=1) for pdf in batches), schema)


def stored(df: DataFrame, name: str, batch: int = NUMBERS) -> DataFrame:
    """df, written once to the shared folder and read back: a cut of the lineage that survives lost executors.

    batch: rows of a Python worker's batch while df is made.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    schema = df.schema
    with batches_of(spark, batch):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Broadcast tables and shuffles that nothing refers to any more go now, from the driver and the executors.

    Spark drops them when the driver's JVM finds them in its garbage. Until then they, and the plans of queries that are
    done, make its heap grow, and what it has once taken it keeps.
    """
    gc.collect()  # references that Python holds
    spark.sparkContext._jvm.System.gc()


def parts_for(rows: int, per_part: int, spark: SparkSession) -> int:
    """Partitions so that each holds about per_part rows at most, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
