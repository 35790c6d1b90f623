"""Line dedup by winnowing: repeated passages are found by fingerprints, extended both ways, and cut where they come later.

Passages begin and end anywhere in a line, so the hashes that are winnowed are of sliding lines: the ``GRAM`` words from
each word on, line ends ignored. Of each ``WINDOW`` neighbouring hashes the smallest is a fingerprint, so any run of
``LEAST`` = ``GRAM + WINDOW - 1`` words that two places share has a fingerprint in common, at the same distance from its
begin. Places of equal fingerprints are joined and extended both ways in two steps:

1. All runs of ``LEAST`` words that hold a fingerprint lie within the words around it (``LEAST - GRAM`` before, ``LEAST``
   from it on). Of the places of a fingerprint whose words around are the same, all but the first (in the document with the
   smallest doc_id; in a document the first one) are repeats as a whole.
2. Where a fingerprint has several such surroundings, the first place of each goes on. A run of ``LEAST`` words around a
   fingerprint has ``SIDE`` words or more on its left or on its right, so places that share neither side with another
   surrounding are done. For the others, the runs that have this fingerprint as their (last) minimum are compared one by
   one, and again all but the first place of a run are repeats.

So a word is cut exactly if it lies in a run of ``LEAST`` words that stands earlier, in a document with a smaller id or
further up in its own. Neighbouring runs unite to longer ones. Hashes have 64 bits, those compared in either step go with
the fingerprint's own.

A document that is a near duplicate (5-word shingles, similarity ``COPY`` or more) of the document its runs come from is
a copy. ``leave_copies`` leaves what it shares with that document (the first such one) as it is there, for near-dedup to
judge: words that match it are cut where they are cut there, other words where they stand in a run of any document. Where
what is left of the two isn't alike any more, all runs of the copy are cut. Words are compared as they are.

Nulls: a null text has no words; rows without a doc_id pass unchanged and are no first places. Rows with the same doc_id
and text are one document; different texts with the same doc_id don't come before each other, so what they share stays in
both. A passage that repeats within a document is cut at its later places too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXTS, documents, hashed_texts, hashed_words, map_batches, mixed, powers, rolled, small_batches, stored, swept, worker_cache

GRAM, WINDOW, LEAST = 16, 35, 50
#: Words before a fingerprint that a run around it can reach.
BEFORE = LEAST - GRAM
#: Words that a run around a fingerprint has at least on one of the two sides.
SIDE = BEFORE // 2
COPY = 0.8
#: End of a run over all words of a text; such a run counts where the text has LEAST words.
ALL = 2**31 - 1
#: Rows of (document, runs) that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Rows of one or two hashes that are broadcast at most (some 50 MB); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def _sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any run of the items follows (modulo 2**64)."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes))[0], out=sums[1:])
    return sums


def _runs_from(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """Hashes of the runs starts to ends, given as positions or as slices of all positions."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][: len(sums)][starts])


def run_hashes_of(sums: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n items from each item on, from the items' running sums."""
    if len(sums) <= n:
        return sums[:0]
    return _runs_from(sums, slice(None, len(sums) - n), slice(n, None))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    return run_hashes_of(_sums(hashes), n)


def _sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """The best of each n neighbours, by doubling."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


def winnowed(grams: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Positions of the smallest hash of each window (each of them where it stands twice). apart: windows to leave out."""
    least = _sliding(grams, WINDOW, np.minimum)
    least[apart] = 0
    edge = np.zeros(WINDOW - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum) == grams)


def minima(grams: np.ndarray) -> np.ndarray:
    """Position of the smallest hash of each window, the last one of equal hashes."""
    back = len(grams) - 1 - np.argsort(grams[::-1], kind="stable")
    rank = np.empty(len(grams), np.int64)
    rank[back] = np.arange(len(grams))
    return back[_sliding(rank, WINDOW, np.minimum)]


def chains(text: np.ndarray, around: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, step, last, again) of the places ``at`` of texts: indices of first places, and their steps and last places.

    Places of a text with equal hashes of the words around that follow at one step of no more than those words are one
    chain: a text that says a few words again and again has a place for each. A place alone has step 0. again: an earlier
    chain of the text has the same words around.
    """
    order = np.lexsort((at, around, text))
    t, c, p = text[order], around[order], at[order]
    new = np.ones(len(p), bool)
    new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
    step = np.diff(p, prepend=0)
    begins = new | (step > BEFORE + LEAST)
    second = np.concatenate([[False], begins[:-1]])
    begins[1:] |= ~second[1:] & (step[1:] != step[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(p)) - 1
    return order[first], np.where(last > first, step[np.minimum(first + 1, len(p) - 1)], 0), p[last], ~new[first]


class Group:
    """Words of several texts one after another: hashes of their runs, and which runs lie within one text."""

    def __init__(self, words: np.ndarray, count: np.ndarray):
        self.count, self.begin = count, np.cumsum(count) - count
        self.text = np.repeat(np.arange(len(count)), count)
        self.sums = _sums(words)
        self.grams = run_hashes_of(self.sums, GRAM)

    def crossing(self, n: int) -> np.ndarray:
        """Of the run of n words from each word on, whether it reaches into the next text."""
        return self.text[n - 1 :] != self.text[: len(self.text) - n + 1]


_PRINTS = "key long, around long, left long, right long, doc_id long, h long, pos int, step int, last int, n int, again boolean"
_WINDOWS = "run long, key long, doc_id long, h long, pos int, n int, again boolean"


def _fingerprints(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprints of texts with the hashes of the words around, to the left and to the right, as chains; n: the text's words."""
    worker_cache("line_dedup")
    for pdf in batches:
        parts = []
        for row, words, count in hashed_texts(pdf["text"]):
            if len(words) < LEAST:
                continue
            g = Group(words, count)
            at = winnowed(g.grams, g.crossing(LEAST))
            text = g.text[at]
            begin, end = g.begin[text], g.begin[text] + count[text]
            low, high = np.maximum(begin, at - BEFORE), np.minimum(end, at + LEAST)
            around = mixed(_runs_from(g.sums, low, high) + (at - low).astype(np.uint64) * np.uint64(256) + (high - at).astype(np.uint64))
            first, step, last, again = chains(text, around, at)
            at, text, begin, end = at[first], text[first], begin[first], end[first]
            left = _runs_from(g.sums, np.maximum(begin, at - SIDE), at + GRAM)
            right = _runs_from(g.sums, at, np.minimum(end, at + GRAM + SIDE))
            parts.append((g.grams[at], around[first], left, right, text + row, at - begin, step, last - begin, count[text], again))
        if parts:
            key, around, left, right, text, pos, step, last, n, again = (np.concatenate(x) for x in zip(*parts, strict=True))
            hashes = {"key": key, "around": around, "left": left, "right": right}
            named = {c: pdf[c].to_numpy()[text] for c in ("doc_id", "h")}
            numbers = {"pos": pos, "step": step, "last": last, "n": n}
            yield pd.DataFrame({**{c: x.view(np.int64) for c, x in hashes.items()}, **named, **{c: x.astype(np.int32) for c, x in numbers.items()}, "again": again})


def _windows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The runs of LEAST words that have one of a text's places as their last minimum. again: the text has the run before.

    Of the places in ``lefts`` those with SIDE words or more to the left, of those in ``rights`` those with as many to the right.
    """
    worker_cache("line_dedup")
    for pdf in batches:
        parts = []
        for row, words, count in hashed_texts(pdf["text"]):
            g = Group(words, count)
            lowest = minima(g.grams)
            wanted = np.zeros((2, len(g.grams)), bool)
            for side, name in enumerate(("lefts", "rights")):
                for begin, places in zip(g.begin.tolist(), pdf[name].iloc[row : row + len(count)], strict=True):
                    wanted[side, begin + places] = True
            before = lowest - np.arange(len(lowest))
            found = (wanted[0, lowest] & (before >= SIDE)) | (wanted[1, lowest] & (before <= BEFORE - SIDE))
            found = np.flatnonzero(found & ~g.crossing(LEAST))
            text, runs = g.text[found], _runs_from(g.sums, found, found + LEAST)
            order = np.lexsort((runs, text))
            again = np.zeros(len(found), bool)
            again[order[1:]] = (runs[order[1:]] == runs[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
            parts.append((runs, g.grams[lowest[found]], text + row, found - g.begin[text], count[text], again))
        if parts:
            runs, key, text, pos, n, again = (np.concatenate(x) for x in zip(*parts, strict=True))
            named = {c: pdf[c].to_numpy()[text] for c in ("doc_id", "h")}
            yield pd.DataFrame({"run": runs.view(np.int64), "key": key.view(np.int64), **named, "pos": pos.astype(np.int32), "n": n.astype(np.int32), "again": again})


def _hinted(df: DataFrame, most: int) -> DataFrame:
    """A stored table, to be broadcast where it is small (counted): so that no hot key of the other side is shuffled."""
    return F.broadcast(df) if df.count() <= most else df


def _some(texts: DataFrame, names: DataFrame) -> DataFrame:
    """The texts with these names (doc_id, h). The names are broadcast when they are few, counted before."""
    return texts.join(_hinted(stored(names, "names"), BROADCAST_ROWS), ["doc_id", "h"], "left_semi")


def _firsts(places: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first_id) where several documents have a place. Numbers alone, so rows add up by hash before the shuffle."""
    found = places.groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("_last"))
    return stored(found.where("first_id < _last").drop("_last"), "firsts")


def _shared(places: DataFrame, side: str) -> DataFrame:
    """(doc_id, h, places) of the places whose words on a side another surrounding of their fingerprint has too."""
    twice = stored(places.groupBy("key", side).agg(F.count("*").alias("m")).where("m > 1").select("key", side), side)
    on = places.join(_hinted(twice, BROADCAST_KEYS // 2), ["key", side], "left_semi")
    return on.groupBy("doc_id", "h").agg(F.collect_set("pos").alias(f"{side}s"))


def _pairs(texts: DataFrame, prints: DataFrame) -> DataFrame:
    """(doc_id, h, n, first_id, runs): each document's runs (a to b) that stand earlier, by the document they stand in first; null: its own."""
    pos, step, n = F.col("pos"), F.col("step"), F.col("n")
    run = lambda a, b: F.struct(F.greatest(F.lit(0), a).alias("a"), F.least(n, b).alias("b")).alias("run")
    named = ["doc_id", "h", "n", "first_id"]
    new = prints.where("not again")
    twice = stored(new.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "twice")
    met = new.select("key", "around", "left", "right", "doc_id", "h", "pos", "n").join(_hinted(twice, BROADCAST_KEYS), "key", "left_semi")
    met = stored(met, "met")
    marked = stored(met.join(_hinted(_firsts(met, ["key", "around"]), BROADCAST_KEYS // 2), ["key", "around"], "left"), "marked")
    whole = marked.where("doc_id > first_id").select(*named, run(pos - BEFORE, pos + LEAST))
    # the first places of several surroundings of one fingerprint: run by run
    rest = marked.where("first_id is null or doc_id = first_id")
    places = stored(_shared(rest, "left").join(_shared(rest, "right"), ["doc_id", "h"], "full"), "places")
    held = _some(texts, places.select("doc_id", "h")).dropDuplicates(["doc_id", "h"])
    none = F.array().cast("array<int>")
    work = held.join(places, ["doc_id", "h"]).withColumns({c: F.coalesce(c, none) for c in ("lefts", "rights")})
    windows = stored(work.mapInPandas(_windows, _WINDOWS), "windows", TEXTS)
    firsts = _firsts(windows.where("not again"), ["run", "key"])
    # by hash and after a shuffle whatever the size: the first places are unique, a hot run's other side can be split
    single = windows.where("not again").join(firsts.hint("shuffle_hash"), ["run", "key"]).where("doc_id > first_id").select(*named, run(pos, pos + LEAST))
    own = F.lit(None).cast("long").alias("first_id")
    again = windows.where("again").select("doc_id", "h", "n", own, run(pos, pos + LEAST))
    # a chain repeats its own first place, and one that stands again its first place too
    begin = F.when(F.col("again"), pos).otherwise(pos + step) - BEFORE
    chained = prints.where("again or step > 0").select("doc_id", "h", "n", own, run(begin, F.col("last") + LEAST))
    every = whole.unionByName(single).unionByName(again).unionByName(chained)
    return stored(every.groupBy(*named).agg(F.collect_list("run").alias("runs")), "pairs")


def along(own: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (a, b, d) of LEAST words or more that two texts share, d words further on in the first: at the distances of runs
    that each has once, and of the two begins and ends."""
    once = []
    for words in (own, first):
        hashes, at, n = np.unique(run_hashes(words, LEAST), return_index=True, return_counts=True)
        once.append((hashes[n == 1], at[n == 1]))
    _, i, j = np.intersect1d(once[0][0], once[1][0], assume_unique=True, return_indices=True)
    out = []
    for d in sorted({0, len(own) - len(first), *(once[0][1][i] - once[1][1][j]).tolist()}):
        a = max(0, d)  # where the diagonal begins in own
        n = min(len(own) - a, len(first) - (a - d))
        differ = np.flatnonzero(own[a : a + n] != first[a - d : a - d + n]) if n > 0 else np.zeros(0, np.int64)
        edges = np.concatenate([[-1], differ, [max(n, 0)]])
        long_ = np.flatnonzero(np.diff(edges) > LEAST)
        out += [(int(edges[k]) + 1 + a, int(edges[k + 1]) + a, d) for k in long_.tolist()]
    return out


def _copied(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Which pairs are near duplicates: (doc_id, h, first_id, first_h)."""
    worker_cache("line_dedup")
    name, first = None, np.zeros(0, np.uint64)
    for pdf in batches:
        keep = []
        for x in pdf.itertuples(index=False):
            if name != (x.first_id, x.first_h):
                name, first = (x.first_id, x.first_h), np.unique(rolled(hashed_words(x.first_text), 5))
            own = np.unique(rolled(hashed_words(x.text), 5))
            both = len(np.intersect1d(own, first, assume_unique=True))
            keep.append(both >= COPY * (len(own) + len(first) - both))
        yield pdf.loc[keep, ["doc_id", "h", "first_id", "first_h"]]


def _copies(pairs: DataFrame, texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs of a document and an earlier one that are near duplicates (doc_id, h, first_id, first_h).

    Texts are compared where a document's runs, from whichever documents, hold three tenths of the words of the longer
    text: of a near duplicate's words many more stand earlier, unless a difference stands in every run of ``LEAST``.
    """
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))
    add = lambda t, r: F.struct(F.greatest(t["end"], r["b"]).alias("end"), (t["words"] + F.greatest(F.lit(0), r["b"] - F.greatest(t["end"], r["a"]))).alias("words"))
    shared = F.aggregate(F.array_sort(F.flatten(F.collect_list("runs"))), zero, add, lambda t: t["words"])
    totals = pairs.groupBy("doc_id", "h", "n").agg(shared.alias("shared"))
    totals = stored(totals.where("10 * shared >= 3 * n").drop("n"), "totals")
    longest = sizes.groupBy(F.col("doc_id").alias("first_id")).agg(F.max("n").alias("first_n"))
    likely = pairs.where("first_id is not null").select("doc_id", "h", "first_id").join(totals, ["doc_id", "h"]).join(longest, "first_id")
    likely = stored(likely.where("10 * shared >= 3 * first_n").select("doc_id", "h", "first_id"), "likely")
    held = _some(texts, likely.select("doc_id", "h").distinct()).dropDuplicates(["doc_id", "h"])
    ids = stored(likely.select(F.col("first_id").alias("doc_id")).distinct(), "ids")
    firsts = texts.join(_hinted(ids, BROADCAST_ROWS), "doc_id", "left_semi").dropDuplicates(["doc_id", "h"])
    both = likely.join(held, ["doc_id", "h"]).join(firsts.withColumnsRenamed({"doc_id": "first_id", "h": "first_h", "text": "first_text"}), "first_id")
    return stored(both.mapInPandas(_copied, "doc_id long, h long, first_id long, first_h long"), "copied", TEXTS // 2)


def repeated_runs(docs: DataFrame, leave_copies: bool = False) -> DataFrame:
    """(doc_id, h, starts, ends, copy): word ranges of each document that stand earlier in the corpus, by document.

    leave_copies: of copies only the ranges to cut, perhaps none (see above).
    h is the text's xxhash64, which with the doc_id names a document. Ranges may overlap. copy: the document is a near duplicate of one that its ranges come from.
    """
    whole = docs.where("doc_id is not null").select("doc_id", "text")
    texts = whole.select("doc_id", F.xxhash64("text").alias("h"), "text")
    copies = _whole_copies(whole)
    few = copies.count() <= BROADCAST_ROWS
    names = copies.select("doc_id", "h")
    texts = texts.join(F.broadcast(names), ["doc_id", "h"], "left_anti") if few else texts
    prints = texts.mapInPandas(_fingerprints, _PRINTS)
    prints = stored(prints if few else stored(prints, "every", TEXTS).join(names, ["doc_id", "h"], "left_anti"), "prints", TEXTS)
    pairs = _pairs(texts, prints)
    swept(docs.sparkSession)
    copied = _copies(pairs, texts, prints.select("doc_id", "n"))
    swept(docs.sparkSession)
    first = copied.groupBy("doc_id", "h").agg(F.min(F.struct("first_id", "first_h")).alias("of"))
    both = pairs.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("runs")).alias("runs")).join(first, ["doc_id", "h"], "left")
    if leave_copies:
        return _of_copies(stored(both, "by_doc"), pairs, copies, texts)
    both = both.select("doc_id", "h", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends"), F.col("of").isNotNull().alias("copy"))
    return stored(both.unionByName(copies.select("doc_id", "h", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends"), "copy")), "by_doc")


def _whole_copies(docs: DataFrame) -> DataFrame:
    """Documents whose whole text stands earlier, found by 128-bit hashes: one run over all words (``ALL``), a copy."""
    names = stored(docs.select("doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), F.col("text")).alias("g")).where("text is not null"), "texts")
    first = stored(names.groupBy("h", "g").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "first")
    later = names.join(_hinted(first, BROADCAST_KEYS // 4), ["h", "g"]).where("doc_id > first_id").groupBy("doc_id", "h").agg(F.min("first_id").alias("first_id"))
    runs = F.array(F.struct(F.lit(0).alias("a"), F.lit(ALL).alias("b")))
    return stored(later.select("doc_id", "h", "first_id", runs.alias("runs"), F.lit(True).alias("copy")), "copies")


def _mask(n: int, runs: Iterable) -> np.ndarray:
    """Which of n words lie in runs (start, end, ...)."""
    out = np.zeros(n, bool)
    for a, b, *_ in () if runs is None else runs:
        out[a:b] = True
    return out


def _alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether texts of these words are copies of each other."""
    if not len(one) or not len(other):
        return False
    one, other = np.unique(rolled(one, 5)), np.unique(rolled(other, 5))
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both >= COPY * (len(one) + len(other) - both)


def copy_ranges(own: np.ndarray, first: np.ndarray, shared: list, others: list, first_cut: list, rest: Iterable = ()) -> list[tuple[int, int]]:
    """Ranges to cut from a copy, given its runs along the document it copies and along others, and what is cut there.

    A word that lies in several runs along the first document belongs to the longest. rest: further runs of the copy, which
    count where what is left of the two isn't alike.
    """
    gone_first = _mask(len(first), first_cut)
    at = np.full(len(own), -1)
    for a, b, d in sorted(shared, key=lambda r: (r[1] - r[0], -abs(r[2]))):
        at[a:b] = np.arange(a - d, b - d)
    gone = np.where(at >= 0, gone_first[at], _mask(len(own), others))
    if not _alike(own[~gone], first[~gone_first]):
        gone = _mask(len(own), [*shared, *others, *rest])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _cut_like_first(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_cache("line_dedup")
    pairs = lambda runs: [] if runs is None else [(r["a"], r["b"]) for r in runs]
    for pdf in batches:
        rows = []
        for x in pdf.itertuples(index=False):
            own, first = hashed_words(x.text), hashed_words(x.first_text)
            ranges = copy_ranges(own, first, along(own, first), pairs(x.others), pairs(x.first_cut), pairs(x.same))
            rows.append((x.doc_id, x.h, [a for a, _ in ranges], [b for _, b in ranges]))
        yield pd.DataFrame(rows, columns=["doc_id", "h", "starts", "ends"])


def _of_copies(runs: DataFrame, pairs: DataFrame, copies: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, h, starts, ends, copy) to cut, with copies cut as the documents that they copy.

    Documents come after those that they copy, so each round settles the copies of settled documents: as many rounds as
    the longest chain of copies of copies.
    """
    same = F.col("first_id").eqNullSafe(F.col("of.first_id"))
    near = pairs.join(runs.where("of is not null").select("doc_id", "h", "of"), ["doc_id", "h"]).groupBy("doc_id", "h").agg(
        F.first("of").alias("of"),
        F.flatten(F.collect_list(F.when(same, F.col("runs")))).alias("same"),
        F.flatten(F.collect_list(F.when(~same, F.col("runs")))).alias("others"),
    )
    waiting = stored(near.select("doc_id", "h", F.col("of.first_id").alias("first_id"), F.col("of.first_h").alias("first_h"), "same", "others"), "near")
    settled = runs.where("of is null").select("doc_id", "h", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends"))
    held = ["doc_id", "h"]
    named = lambda df: df.withColumnsRenamed({"doc_id": "first_id", "h": "first_h"})
    none = F.array().cast("array<int>")
    near = settled.limit(0)
    while not waiting.isEmpty():
        ready = waiting.join(named(waiting.select(held)), ["first_id", "first_h"], "left_anti")
        cut_there = named(settled.unionByName(near).select(*held, F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b")).alias("first_cut")))
        ready = stored(ready.join(cut_there, ["first_id", "first_h"], "left"), "ready")
        some = (F.size("others") > 0) | (F.coalesce(F.size("first_cut"), F.lit(0)) > 0)
        work = ready.where(some)
        names = work.select(held).unionByName(work.select(F.col("first_id").alias("doc_id"), F.col("first_h").alias("h"))).distinct()
        own = _some(texts, names).dropDuplicates(held)
        both = work.join(own, held).join(named(own).withColumnRenamed("text", "first_text"), ["first_id", "first_h"])
        done = both.mapInPandas(_cut_like_first, "doc_id long, h long, starts array<int>, ends array<int>")
        done = done.unionByName(ready.where(~some).select(*held, none.alias("starts"), none.alias("ends")))
        near = near.unionByName(stored(done, "settled", TEXTS // 2))
        waiting = stored(waiting.join(ready.select(held), held, "left_anti"), "near")
    every = settled.withColumn("copy", F.lit(False)).unionByName(near.withColumn("copy", F.lit(True)))
    of = every.select(F.col("doc_id").alias("first_id"), "h", "starts", "ends")
    whole = copies.select("doc_id", "h", "first_id").join(of, ["first_id", "h"], "left")
    whole = whole.select(*held, F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"), F.lit(True).alias("copy"))
    return stored(every.unionByName(whole), "by_doc")


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of a text's words, in characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = ~((points == 32) | (points - np.uint32(9) <= 4))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def cut(text: str, starts: Iterable[int], ends: Iterable[int]) -> tuple[str, int]:
    """The text without these ranges of words, and the number of words cut. A line without words left goes with its end."""
    begins, stops = word_spans(text)
    gone = np.zeros(len(begins), bool)
    for a, b in zip(starts, ends, strict=True):
        if b != ALL or len(begins) >= LEAST:
            gone[a:b] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        begin, end = int(begins[a]), int(begins[b]) if b < len(begins) else len(text)
        out.append(text[at:begin])
        gap = text[stops[b - 1] : end]
        before = out[-1][-1:] or (text[begin - 1 : begin] if at != begin else "\n")
        if "\n" in gap and before != "\n" and b < len(begins):
            out.append("\n")
        at = end
    out.append(text[at:])
    new = "".join(out)
    return (new.rstrip(" \t") if gone.any() else new), int(gone.sum())


def line_dedup(docs: DataFrame, leave_copies: bool = True) -> DataFrame:
    """docs without later repeated passages; adds n_cut (words cut) and is_copy. n_chars follows the text.

    Columns of docs with these names are replaced. Documents whose words are all cut stay, with what is left.
    """
    runs = repeated_runs(docs, leave_copies)
    few = runs.count() <= BROADCAST_ROWS
    own = "_run"
    while any(c.lower().startswith(own) for c in docs.columns):  # names that docs doesn't have
        own = "_" + own
    runs = runs.select(*(F.col(c).alias(f"{own}_{c}") for c in ("doc_id", "h", "starts", "ends", "copy")))
    names = [c for c in docs.columns if c not in ("n_cut", "is_copy")]
    rows = docs.select(*(F.col(f"`{c}`") for c in names))
    same = (rows["doc_id"] == runs[f"{own}_doc_id"]) & (F.xxhash64(rows["text"]) == runs[f"{own}_h"])
    joined = rows.join(F.broadcast(runs) if few else runs, same, "left")
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("n_cut", T.LongType()), T.StructField("is_copy", T.BooleanType())])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [cut(t, a, b) if len(a) else (t, 0) for t, a, b in zip(pdf["text"], pdf[f"{own}_starts"], pdf[f"{own}_ends"], strict=True)]
            out = pdf[names].assign(text=[t for t, _ in done], n_cut=[n for _, n in done])
            out["is_copy"] = pdf[f"{own}_copy"].astype(bool)
            if "n_chars" in names:
                out["n_chars"] = [c if n == 0 else len(t) for c, n, t in zip(out["n_chars"], out["n_cut"], out["text"], strict=True)]
            yield out[schema.names]

    whole = joined.where(F.col(f"{own}_starts").isNull()).select(*(f"`{c}`" for c in names), F.lit(0).cast("long").alias("n_cut"), F.lit(False).alias("is_copy"))
    return whole.unionAll(map_batches(joined.where(F.col(f"{own}_starts").isNotNull()), run, schema))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_cut, is_copy, text_sha256 (of the text that is left; null: empty)."""
    small_batches(spark)
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"), leave_copies=False)
    return out.select("doc_id", "n_cut", "is_copy", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLES: dict[str, str] = {}
