"""Quality rules: counted base rules and n-gram perplexity bands.

Perplexity comes from a modified Kneser-Ney model of order 5 over the characters of marked words: a word is its code
points and an end mark, what stands before it is no context. So a word costs what it is worth by itself, and a text of
words that are rare in its language costs more for each of them, even where it is written in one rare way throughout.
Spark counts the n-grams of all documents by language, nothing is folded, and the tables grow with the input: distinct
n-grams are rows (language, two packed numbers), lower orders and probabilities follow by joins. For scoring, an n-gram's
log-probability is looked up by hash in a sorted array. Where the model has ``BROADCAST_GRAMS`` rows at most the array is
broadcast; a larger model is joined with the distinct n-grams of each block of documents, and a block has an array of its
own.

Verdict: a document fails the base rules, or its mean log-perplexity a word lies outside its language's band. A mean over
n words scatters with the root of n, so the band around the language's median is ``reach`` times the quartile distance
(to either side) of (mean - median) * sqrt(n), divided by sqrt(n), and ``least`` at least. Quartiles are of the documents
that pass the base rules, from histograms of rounded values, so reruns agree.

Nulls: a null text has no words, fails the base rules and has a null perplexity; a null language is a language of its own.
Rows without a doc_id and repeated rows are judged like others, each for itself (and all count in the model). Other
columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import TEXTS, documents, mixed, rolled, stored, word_groups, worker_cache

ORDER = 5
#: Bits of a packed code point; END is a word's end, NONE stands for what is before its begin.
BITS = 21
END, NONE = 32, 0x110000
MASK = (1 << BITS) - 1
REACH, LEAST = 8.0, 0.5
MIN_WORDS, MOST_REPEATED = 50, 50
#: N-grams of a model that is broadcast (12 bytes each); a larger one is joined by blocks of documents.
BROADCAST_GRAMS = 4_000_000
#: Bytes of text in a block of documents then, and n-grams that a counting task holds.
BLOCK, HELD = 64_000_000, 1_000_000
WHITE = b" \t\n\x0b\x0c\r"

_PRIME = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash_longs(*columns: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of columns of longs, on 64-bit arrays (public algorithm XXH64, seed 42)."""
    h = np.full(len(columns[0]), 42, np.uint64)
    for x in columns:
        h = (h + _PRIME[4] + np.uint64(8)) ^ (_turned(x.astype(np.uint64) * _PRIME[1], 31) * _PRIME[0])
        h = _turned(h, 27) * _PRIME[0] + _PRIME[3]
        h = (h ^ (h >> np.uint64(33))) * _PRIME[1]
        h = (h ^ (h >> np.uint64(29))) * _PRIME[2]
        h ^= h >> np.uint64(32)
    return h


def symbols(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points of words given as byte ranges, each with END after it."""
    n = end - begin + 1
    after = np.cumsum(n)
    raw = np.frombuffer(data, np.uint8)
    out = raw[np.minimum(np.repeat(begin - (after - n), n) + np.arange(after[-1]), len(raw) - 1)]
    out[after - 1] = END
    return np.frombuffer(out.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hi, lo): at each symbol the n-gram that ends there. lo packs the symbol and the two before it, hi the two before those."""
    at = np.arange(len(points))
    begins = np.concatenate([[True], points[:-1] == END])
    place = at - np.maximum.accumulate(np.where(begins, at, 0))
    back = [points, *(np.where(place >= j, np.concatenate([points[:j], points[:-j]])[: len(points)], np.uint64(NONE)) for j in range(1, ORDER))]
    packed = [x << np.uint64(BITS * k) for x, k in zip(back, (0, 1, 2, 0, 1), strict=True)]
    return packed[3] | packed[4], packed[0] | packed[1] | packed[2]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, first place of each number): equal values share a number."""
    of, distinct = pd.factorize(values)
    first = np.empty(len(distinct), np.int64)
    first[of[::-1]] = np.arange(len(of) - 1, -1, -1)
    return of, first


def distinct_words(languages: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, first place of each number) of the distinct words of a group, by language."""
    return _numbered(hashes ^ mixed(languages.view(np.uint64)))


def distinct_grams(lang: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of n-grams, given as language, hi and lo."""
    h = (hi * _PRIME[0]) ^ lang.view(np.uint64)
    return _numbered((h ^ (h >> np.uint64(31))) * _PRIME[1] + lo * _PRIME[2])


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Counts of equal n-grams (language, hi, lo, n) added up."""
    lang, hi, lo, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]
    of, first = distinct_grams(lang, hi, lo)
    return lang[first], hi[first], lo[first], np.bincount(of, n).astype(np.int64)


def _counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_cache("quality_rules")
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("lk", "hi", "lo", "n"), (x.view(np.int64) for x in held[0]), strict=True)))

    for pdf in batches:
        languages = pdf["lk"].to_numpy()
        for text, words, begin, end, data in word_groups(pdf["text"]):
            if not len(words):
                continue
            of, first = distinct_words(languages[text], words)
            count = np.bincount(of)
            points = symbols(data, begin[first], end[first])
            word = np.concatenate([[0], np.cumsum(points == END)[:-1]])
            held.append(_added([(languages[text][first][word], *grams(points), count[word])]))
            if len(held) >= 16:
                held = [_added(held)]
                if len(held[0][0]) > HELD:
                    yield out()
                    held = []
    if held:
        held = [_added(held)]
        yield out()


def count_grams(docs: DataFrame) -> DataFrame:
    """(lk, hi, lo, n) over all documents; lk is the language's xxhash64 (null: 42)."""
    counted = docs.select(F.xxhash64("lang").alias("lk"), "text").mapInPandas(_counted, "lk long, hi long, lo long, n long")
    return counted.groupBy("lk", "hi", "lo").agg(F.sum("n").alias("n"))


def _shorter(order: int) -> tuple[Column, Column]:
    """hi and lo of an n-gram of this order without its oldest symbol."""
    hi, lo = F.col("hi"), F.col("lo")
    kept = lo.bitwiseAND(F.lit((1 << BITS * min(order - 1, 3)) - 1))
    return (hi.bitwiseAND(F.lit(MASK)) if order == 5 else F.lit(0).cast("long")).alias("hi"), kept.alias("lo")


def probabilities(counts: DataFrame) -> DataFrame:
    """(lk, hi, lo, p) of every counted n-gram: modified Kneser-Ney, interpolated down to order 1 and the alphabet.

    A lower order counts the distinct symbols before; discounts of counts 1, 2 and 3 or more come from the counts of counts
    of each language and order.
    """
    tables = {ORDER: counts}
    for m in range(ORDER, 1, -1):
        hi, lo = _shorter(m)
        tables[m - 1] = stored(tables[m].groupBy("lk", hi, lo).agg(F.count("*").alias("n")), f"order-{m - 1}")
    n, p = F.col("n"), None
    for m in range(1, ORDER + 1):
        k = [F.count_if(n == i).cast("double") for i in (1, 2, 3, 4)]
        y, some = k[0] / (k[0] + 2 * k[1]), (k[0] > 0) & (k[1] > 0) & (k[2] > 0)
        best = [i + 1 - (i + 2) * y * k[i + 1] / F.when(k[i] > 0, k[i]) for i in range(3)]
        bounded = lambda c, i: F.greatest(F.lit((0.05, 0.1, 0.15)[i]), F.least(F.lit((0.95, 1.9, 2.85)[i]), c))
        rare = tables[m].groupBy("lk").agg(*(F.when(some, bounded(c, i)).otherwise((0.5, 0.75, 0.9)[i]).alias(f"d{i + 1}") for i, c in enumerate(best)))
        own = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        after = W.partitionBy("lk") if m == 1 else W.partitionBy("lk", "hi", F.shiftright("lo", BITS))  # as many rows as the alphabet at most
        left = sum((F.sum((n == i).cast("long")).over(after) * F.col(f"d{i}") for i in (1, 2)), F.sum((n > 2).cast("long")).over(after) * F.col("d3"))
        total = F.sum("n").over(after)
        rows = tables[m].join(stored(rare, "discounts"), "lk").select("lk", "hi", "lo", ((n - own) / total).alias("own"), (left / total).alias("left"), F.count("*").over(after).alias("symbols"))
        if p is None:
            p = rows.select("lk", "hi", "lo", (F.col("own") + F.col("left") / F.col("symbols")).alias("p"))
        else:
            hi, lo = _shorter(m)
            lower = p.select("lk", F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), F.col("p").alias("lower"))
            rows = rows.withColumns({"s_hi": hi, "s_lo": lo}).join(lower.hint("shuffle_hash"), ["lk", "s_hi", "s_lo"])  # not by the driver
            p = rows.select("lk", "hi", "lo", (F.col("own") + F.col("left") * F.col("lower")).alias("p"))
        p = stored(p, f"p-{m}")
    return p


def base_statistics(text: str | None, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words' hashes."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    word_chars = len(text) - (len(data) - len(data.translate(None, WHITE)))
    n_symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    lines = [line for line in data.split(b"\n") if line.strip(WHITE)]
    repeated = 0
    if len(words) >= 3:
        _, at, n = np.unique(rolled(words, 3), return_inverse=True, return_counts=True)
        twice = n[at] > 1
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k : k + len(twice)] |= twice
        repeated = int(covered.sum())
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated


def scored(pdf: pd.DataFrame, keys: np.ndarray, logs: np.ndarray) -> pd.DataFrame:
    """doc_id, lk, the base statistics and the mean log-perplexity a word of each row, given the model as a sorted array."""
    languages = pdf["lk"].to_numpy()
    total = np.zeros(len(pdf))
    words: list[list[np.ndarray]] = [[] for _ in range(len(pdf))]
    for text, hashes, begin, end, data in word_groups(pdf["text"]):
        if not len(hashes):
            continue
        of, first = distinct_words(languages[text], hashes)
        points = symbols(data, begin[first], end[first])
        ends = np.flatnonzero(points == END)
        lang = np.repeat(languages[text][first], np.diff(ends, prepend=-1))
        hi, lo = grams(points)
        gram, where = distinct_grams(lang, hi, lo)
        at = np.searchsorted(keys, xxhash_longs(lang[where].view(np.uint64), hi[where], lo[where]))
        each = np.add.reduceat(logs[at].astype(float)[gram], np.concatenate([[0], ends[:-1] + 1]))
        total += np.bincount(text, each[of], minlength=len(pdf))
        cuts = np.flatnonzero(np.diff(text, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True):
            words[text[a]].append(hashes[a:b])
    none = np.zeros(0, np.uint64)
    every = [w[0] if len(w) == 1 else np.concatenate(w) if w else none for w in words]
    out = pd.DataFrame([base_statistics(t, w) for t, w in zip(pdf["text"], every, strict=True)], columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
    out.insert(0, "doc_id", pdf["doc_id"].array)
    out["lk"] = languages
    n = out["n_words"].to_numpy()
    out["log_perplexity"] = pd.array(np.round(-total / np.maximum(n, 1), 6), dtype="Float64")
    out.loc[n == 0, "log_perplexity"] = pd.NA
    return out


_SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lk long, log_perplexity double"


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, the base statistics, lk and log_perplexity of every row; model: (lk, hi, lo, p) of all n-grams of docs."""
    rows = docs.select("doc_id", F.xxhash64("lang").alias("lk"), "text")
    model = model.select("lk", "hi", "lo", F.xxhash64("lk", "hi", "lo").alias("key"), F.log("p").cast("float").alias("log"))
    if model.count() > BROADCAST_GRAMS:
        return _score_by_blocks(rows, model)
    table = model.select("key", "log").toArrow()  # counted above
    keys, logs = table["key"].to_numpy().view(np.uint64), table["log"].to_numpy()
    order = np.argsort(keys)
    sent = docs.sparkSession.sparkContext.broadcast((keys[order], logs[order]))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("quality_rules")
        for pdf in batches:
            yield scored(pdf, *sent.value)

    return rows.mapInPandas(run, _SCORED)


def _score_by_blocks(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Documents dealt into blocks; each block's distinct n-grams, counted once more, fetch their log-probabilities."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]  # one number
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK + 1)))

    def wanted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, part in pdf.groupby("block"):
                for found in _counted([part]):
                    yield found.drop(columns="n").assign(block=block)

    grams_ = dealt.mapInPandas(wanted, "lk long, hi long, lo long, block long").distinct()
    answers = grams_.join(model, ["lk", "hi", "lo"]).select("block", "key", "log")

    def run(part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        keys, logs = found["key"].to_numpy().view(np.uint64), found["log"].to_numpy()
        order = np.argsort(keys)
        return scored(part.reset_index(drop=True), keys[order], logs[order])

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, _SCORED)


def _quartiles(rows: DataFrame, value: Column, step: float) -> DataFrame:
    """(lk, q1, q2, q3) of a value in steps; counts of equal steps first, so a language's rows are as many as its steps."""
    bins = rows.groupBy("lk", F.round(value / step).cast("long").alias("bin")).agg(F.count("*").alias("m"))
    before, every = F.sum("m").over(W.partitionBy("lk").orderBy("bin")), F.sum("m").over(W.partitionBy("lk"))
    share = bins.select("lk", "bin", (before / every).alias("share"))
    return share.groupBy("lk").agg(*((F.min(F.when(F.col("share") >= k / 4, F.col("bin"))) * step).alias(f"q{k}") for k in (1, 2, 3)))


def rules(docs: DataFrame, reach: float = REACH, least: float = LEAST) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    model = probabilities(stored(count_grams(docs), "grams", TEXTS))
    rows = stored(score(docs, model).withColumn("base_failed", failed), "scored", TEXTS)
    passed = rows.where("not base_failed and log_perplexity is not null")
    middle = stored(_quartiles(passed, F.col("log_perplexity"), 0.001).select("lk", F.col("q2").alias("middle")), "middle")
    apart = (F.col("log_perplexity") - F.col("middle")) * F.sqrt("n_words")
    spread = stored(_quartiles(passed.join(middle, "lk"), apart, 0.01).select("lk", "q1", "q3"), "spread")
    wide = lambda q: F.greatest(F.lit(least), reach * F.abs(F.col(q)) / F.sqrt("n_words"))
    out = rows.join(middle, "lk", "left").join(spread, "lk", "left")
    inside = F.col("log_perplexity").between(F.col("middle") - wide("q1"), F.col("middle") + wide("q3"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "log_perplexity")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(documents(spark, sf_dir))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES: dict[str, str] = {}
