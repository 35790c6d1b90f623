"""Near duplicates by an LSH forest of MinHash signatures.

Documents are sets of distinct 5-word shingles (A-Z lower-cased). Texts with the same words are folded first. Each
remaining text gets a signature of 256 one-byte MinHash values, read as 32 trees of 8 levels. A tree is the texts sorted
by their 8 values; texts with a common prefix are neighbours. A region of neighbours is as deep as it must be to hold
``REGION`` texts at most (from ``SHALLOW`` levels down to 8); larger regions of equal 8 values are cut into blocks and all
block pairs that can hold a new link are compared. In a region the whole signatures estimate each pair's similarity and
the pairs that can be links (within ``SLACK``) are confirmed on the full sets, in the task of the region; only confirmed
links leave it, those that join texts not joined yet.

Rows are dealt by range. A region that a range's bound may cut, the first and the last of a partition, is put together again
afterwards; where it has more than ``PART`` rows its texts outside the largest component go to each of its parts.

Two rounds: the first, on 4 trees and each text's best neighbours, joins most copies; in the second, on the other
trees, regions whose texts are all joined already are left out, and every pair within the slack is confirmed.

A pair at the threshold of 0.85 shares 5 levels of a given tree with probability 0.44, so it is missed by 28 trees with
probability 1e-7 in small regions; the estimate misses it with probability below 1e-4.

Nulls and empty texts: no shingles, linked with nothing, kept. Rows that share a doc_id count as one document; rows
without a doc_id get no component and are kept. Texts with the same words tie: the smallest doc_id stands for them, and of
equal estimates the smaller ids are compared first; neither changes the result. Other columns of the input aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TEXTS, documents, hashed_words, parts_for, rolled, stored, worker_cache
from .graph import components

WORDS = 5
TREES, LEVELS = 32, 8
SHALLOW, REGION = 5, 256
FIRST_TREES, FIRST_PARTNERS = 4, 4
SLACK = 0.085
#: Rows of a partition that looks for regions.
PART = 1_000_000
#: Ids that are broadcast at most (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_rng = np.random.Generator(np.random.PCG64(11))
_MULTIPLY = (_rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32)[:, None]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text's words; the whole sequence where it has fewer words."""
    return np.unique(rolled(words, WORDS))


def signature(shingles: np.ndarray) -> bytes:
    """TREES * LEVELS MinHash values of a byte each."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(TREES * LEVELS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048][None, :] * _MULTIPLY
        part += _ADD
        np.minimum(best, part.min(axis=1), out=best)
    best ^= best >> np.uint32(15)
    best *= np.uint32(0x85EBCA6B)
    return (best >> np.uint32(24)).astype(np.uint8).tobytes()


def _sketched(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_cache("near_dedup")
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            words = hashed_words(text, fold=True)
            if not len(words):
                rows.append((None, None, 0, None))
                continue
            shingles = shingle_set(words)
            key = xxhash.xxh3_128_digest(words.tobytes())
            rows.append((int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True), len(shingles), signature(shingles)))
        out = pd.DataFrame(rows, columns=["k1", "k2", "n_shingles", "sig"])
        out.insert(0, "doc_id", pdf["doc_id"].array)
        yield out.astype({"k1": "Int64", "k2": "Int64"})


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, k1 and k2 (128-bit hash of the words), n_shingles, sig of every row."""
    return docs.select("doc_id", "text").mapInPandas(_sketched, "doc_id long, k1 long, k2 long, n_shingles long, sig binary")


def region_ids(tree: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each row's region, depth) for rows sorted by tree and band; a row alone has depth 0."""
    n = len(tree)
    same = np.zeros((n, LEVELS), bool)
    same[1:] = np.logical_and.accumulate((bands[1:] == bands[:-1]) & (tree[1:] == tree[:-1])[:, None], axis=1)
    lcp = same.sum(axis=1)
    start, depth, open_ = np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
    for d in range(SHALLOW, LEVELS + 1):
        begins = np.flatnonzero(lcp < d)
        at = np.cumsum(lcp < d) - 1
        size = np.diff(np.append(begins, n))[at]
        done = open_ & ((size <= REGION) | (d == LEVELS))
        start[done], depth[done] = begins[at[done]], np.where(size[done] > 1, d, 0)
        open_ &= ~done
    return start, depth


_PLACES = "region long, tree int, rep long, comp long, n_shingles long, band binary"


def _regions(batches: Iterable[pd.DataFrame], exact: bool, threshold: float = 0.8, hold: bool = False) -> Iterator[pd.DataFrame]:
    """(region, tree, rep) of the texts that have a neighbour of another component and of a fitting size: sets whose sizes differ by more than ``threshold`` can't be links.

    hold: the first and the last region (``SHALLOW`` levels) may go on in other partitions, so their rows come out as they
    are, without a region. Otherwise rows of different ``chunk`` are no neighbours.
    """
    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True)
    if hold:
        tree, band = pdf["tree"].to_numpy(), pdf["band"]
        edge = np.zeros(len(pdf), bool)
        for at in (0, len(pdf) - 1):
            edge |= (tree == tree[at]) & band.str.slice(0, SHALLOW).eq(band[at][:SHALLOW]).to_numpy()
        yield pdf[edge].assign(region=pd.array([None] * int(edge.sum()), "Int64"))
        pdf = pdf[~edge].reset_index(drop=True)
        if not len(pdf):
            return
    for found in _neighbours(pdf, exact, threshold):
        yield found.assign(comp=0, n_shingles=0, band=b"") if hold else found


def _neighbours(pdf: pd.DataFrame, exact: bool, threshold: float) -> Iterator[pd.DataFrame]:
    tree, rep, comp, n = (pdf[c].to_numpy() for c in ("tree", "rep", "comp", "n_shingles"))
    chunk = pdf["chunk"].to_numpy() if "chunk" in pdf else np.zeros(len(pdf), np.int64)
    raw = b"".join(pdf["band"])
    bands = np.frombuffer(raw, np.uint8).reshape(-1, LEVELS)
    start, depth = region_ids(tree + len(_MULTIPLY) * chunk, bands)
    edges = np.append(np.flatnonzero(np.diff(start, prepend=-1)), len(start))
    ids, trees, reps = [], [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if depth[a] == 0:
            continue
        own = comp[a:b]
        if (own == own[0]).all():
            continue
        sizes = np.sort(n[a:b])
        fitting = np.searchsorted(sizes, np.ceil(n[a:b] / threshold), "right") - np.searchsorted(sizes, np.floor(n[a:b] * threshold), "left") > 1
        rows = np.flatnonzero(fitting) + a
        if len(rows) < 2:
            continue
        key = raw[a * LEVELS : a * LEVELS + depth[a]] + b"%d,%d,%d:" % (tree[a], depth[a], chunk[a])
        groups = [(key, rows)]
        if len(rows) > REGION:
            groups = []
            if exact:  # texts outside the largest component come first: a pair of blocks without them holds nothing new
                of, count = np.unique(comp[rows], return_counts=True)
                small = comp[rows] != of[count.argmax()]
                rows = np.concatenate([rows[small], rows[~small]])
                others = -(-int(small.sum()) // REGION)
            blocks = [rows[k : k + REGION] for k in range(0, len(rows), REGION)]
            for i, block in enumerate(blocks):
                if not exact:
                    groups.append((key + b"%d" % i, block))
                elif i < others:
                    groups += [(key + b"%d,%d" % (i, j), block if i == j else np.concatenate([block, blocks[j]])) for j in range(i, len(blocks))]
        for key, rows in groups:
            ids.append(np.full(len(rows), xxhash.xxh3_64_intdigest(key), np.uint64).view(np.int64))
            trees.append(tree[rows])
            reps.append(rep[rows])
            if sum(map(len, ids[-200:])) > 40_000 and len(ids) > 200:
                yield pd.DataFrame({"region": np.concatenate(ids), "tree": np.concatenate(trees), "rep": np.concatenate(reps)})
                ids, trees, reps = [], [], []
    if ids:
        yield pd.DataFrame({"region": np.concatenate(ids), "tree": np.concatenate(trees), "rep": np.concatenate(reps)})


def whole_groups(batches: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Each group of rows with one key, from batches sorted by it."""
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        keys = pdf[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if rest and rest[-1][key].iloc[-1] != keys[0]:
            yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
            rest = []
        for a, b in zip([0, *cuts[:-1]], cuts, strict=True) if len(cuts) else ():
            part = pdf.iloc[a:b]
            yield pd.concat([*rest, part], ignore_index=True) if rest else part
            rest = []
        rest.append(pdf.iloc[cuts[-1] if len(cuts) else 0 :])
    if rest:
        yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]


def _partners(batches: Iterable[pd.DataFrame], threshold: float, most: int, first_tree: int) -> Iterator[pd.DataFrame]:
    """(region, rep, partners): for each text the later texts of its region that may be links, likeliest first.

    most: partners a text at most (0: all). A pair that shares all 8 levels of an earlier tree of the round was met there.
    """
    out: list[tuple] = []
    for group in whole_groups(batches, "region"):
        group = group.drop_duplicates("rep")
        rep, comp, n = (group[c].to_numpy() for c in ("rep", "comp", "n_shingles"))
        tree = int(group["tree"].iloc[0])
        sig = np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(len(group), -1)
        met = sig.reshape(len(group), TREES, LEVELS)[:, first_tree:tree].copy().view(np.uint64)[..., 0] if most == 0 else None
        rows, used = {}, set()
        for i in range(len(group) - 1):
            m = n[i + 1 :]
            fit = (comp[i + 1 :] != comp[i]) & (np.minimum(m, n[i]) >= threshold * np.maximum(m, n[i]))
            if met is not None and met.shape[1]:
                fit &= ~(met[i + 1 :] == met[i]).any(axis=1)
            js = np.flatnonzero(fit) + i + 1
            if not len(js):
                continue
            like = ((sig[js] == sig[i]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            good = np.flatnonzero(like >= threshold - SLACK)
            good = good[np.argsort(-like[good], kind="stable")]
            if most:
                good = good[:most]
            if len(good):
                rows[i] = [int(rep[js[g]]) for g in good]
                used |= {i, *js[good].tolist()}
        region = int(group["region"].iloc[0])
        out += [(region, int(rep[i]), rows.get(i, [])) for i in sorted(used)]
        if len(out) > 5000:
            yield pd.DataFrame(out, columns=["region", "rep", "partners"])
            out = []
    if out:
        yield pd.DataFrame(out, columns=["region", "rep", "partners"])


def _confirmed(batches: Iterable[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Links (a, b) of each region: 100 * intersection >= percent * union on the full sets; pairs joined already are skipped."""
    out: list[tuple] = []
    for group in whole_groups(batches, "region"):
        group = group.drop_duplicates("rep")
        sets = {r: shingle_set(hashed_words(t, fold=True)) for r, t in zip(group["rep"], group["text"], strict=True)}
        root = {r: c for r, c in zip(group["rep"], group["comp"], strict=True)}

        def find(x: int, root=root) -> int:
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        pairs = [(k, a, b) for a, found in zip(group["rep"], group["partners"], strict=True) for k, b in enumerate(found)]
        for _, a, b in sorted(pairs):
            ra, rb = find(a), find(b)
            if ra == rb or b not in sets:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[rb] = ra
                out.append((a, int(b)))
        if len(out) > 5000:
            yield pd.DataFrame(out, columns=["a", "b"])
            out = []
    if out:
        yield pd.DataFrame(out, columns=["a", "b"])


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of the documents with these ids (rep). The ids are broadcast when they are few, counted before."""
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    return texts.join(F.broadcast(ids) if few else ids, "rep", "left_semi")


def _cut_regions(edges: DataFrame, exact: bool, threshold: float) -> DataFrame:
    """(region, tree, rep) of the regions at partitions' ends, put together again; two groups a partition at most."""
    spark, group = edges.sparkSession, ["tree", "near"]
    edges = edges.drop("region").withColumn("near", F.expr(f"substring(band, 1, {SHALLOW})"))
    sizes = edges.groupBy(*group, "comp").agg(F.count("*").alias("m")).groupBy(*group)
    sizes = stored(sizes.agg(F.ceil(F.sum("m") / PART).alias("chunks"), F.max_by("comp", F.struct("m", "comp")).alias("main")), "sizes")
    own = F.array(F.pmod(F.xxhash64("rep"), F.col("chunks")))
    every = F.when(F.col("comp") != F.col("main"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(own) if exact else own
    rows = edges.join(F.broadcast(sizes), group).withColumn("chunk", F.explode(every)).drop("chunks", "main")
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *group, "chunk").sortWithinPartitions("tree", "chunk", "band", "rep")
    return stored(rows.drop("near").mapInPandas(_with(_regions, exact, threshold), "region long, tree int, rep long"), "cut")


def _round(docs: DataFrame, reps: DataFrame, comps: DataFrame | None, trees: range, exact: bool, percent: int) -> DataFrame:
    """Confirmed links between texts of different components, from these trees. reps: rep, n_shingles, sig."""
    spark = docs.sparkSession
    own = reps.withColumn("comp", F.col("rep")) if comps is None else reps.join(comps, reps["rep"] == comps["node"], "left").select("rep", "n_shingles", "sig", F.coalesce("component", "rep").alias("comp"))
    own = own if comps is None else stored(own, "reps")
    n = own.count()
    tree = F.explode(F.lit(list(trees)))
    rows = own.select("rep", "n_shingles", "comp", "sig", tree.alias("tree"))
    rows = rows.select("tree", F.expr(f"substring(sig, tree * {LEVELS} + 1, {LEVELS})").alias("band"), "rep", "comp", F.col("n_shingles"))
    dealt = rows.repartitionByRange(parts_for(n * len(trees), PART, spark), "tree", "band", "rep").sortWithinPartitions("tree", "band", "rep")
    threshold = percent / 100
    regions = stored(dealt.mapInPandas(_with(_regions, exact, threshold, True), _PLACES), "regions")
    regions = regions.where("region is not null").select("region", "tree", "rep").unionByName(_cut_regions(regions.where("region is null"), exact, threshold))
    by_region = lambda df: df.repartition("region").sortWithinPartitions("region", "rep")
    sketched = regions.join(own, "rep")
    pairs = stored(by_region(sketched).mapInPandas(_with(_partners, threshold, 0 if exact else FIRST_PARTNERS, trees.start), "region long, rep long, partners array<long>"), "partners")
    texts = _texts_of(docs, pairs.select("rep").distinct()).dropDuplicates(["rep"])
    full = pairs.join(texts, "rep").join(own.select("rep", "comp"), "rep")
    return stored(by_region(full).mapInPandas(_with(_confirmed, percent), "a long, b long").distinct(), "links", TEXTS)


class _with:
    """A function of batches with its other arguments, to send to the workers."""

    def __init__(self, run: Callable, *args):
        self.run, self.args = run, args

    def __call__(self, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return self.run(batches, *self.args)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text).

    Documents are linked when 100 * intersection >= percent * union; the component is the smallest doc_id reachable.
    """
    sketched = stored(sketches(docs), "sketches", TEXTS)
    groups = stored(sketched.where("k1 is not null and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "texts")
    firsts = sketched.where("k1 is not null").withColumnRenamed("doc_id", "rep").join(groups, ["k1", "k2", "rep"], "left_semi")
    reps = stored(firsts.dropDuplicates(["rep"]).select("rep", "n_shingles", "sig"), "reps")
    links = _round(docs, reps, None, range(FIRST_TREES), False, percent)
    comps = stored(components(links), "components")
    more = _round(docs, reps, comps, range(FIRST_TREES, TREES), True, percent)
    comps = stored(components(links.unionByName(more)), "components")
    named = groups.join(comps, groups["rep"] == comps["node"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    # rows of one text are skewed where many copy it; adaptive execution splits them, the other side is unique
    out = sketched.select("doc_id", "k1", "k2", "n_shingles").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), 85)


QUERIES = {"op4_near_dedup": op4_near_dedup}
ORACLES: dict[str, str] = {}
