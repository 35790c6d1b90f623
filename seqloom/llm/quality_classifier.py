"""Quality classifier by co-training of a text view and a page-metadata view.

Two questions, each with its own pair of models: is a document of low quality, is it toxic. The text view sees the set of
its words, their beginnings and the shares of word shapes; the metadata view sees source, language and layout (length,
lines, shares of upper case, signs and digits). Both are logistic regressions, fitted on the driver to a bounded sample:
``LABELLED`` labelled and ``POOL`` unlabelled documents, the smallest by a seeded hash of the doc_id. In each round either
view labels the pool's documents that it is sure of for the other one. Each view is calibrated (Platt) on labelled
documents held out; the calibrated log-odds are added, less the prior's, and calibrated again. All documents are scored.

A document is kept unless its probability of low quality or of being toxic reaches ``REJECT``.

Nulls: a null text counts as empty, a null source or language is a value of its own, a null label leaves its question open.
Without labels of both kinds for a question, its probability is 0 for all. Labels of one doc_id that differ: the lower
quality and the toxic one count. Rows that share a doc_id are scored each for itself; one of them is fitted. Columns named
p_low, p_toxic and kept are replaced, others are kept.
"""

from __future__ import annotations

import gc
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_batches, released, small_batches, worker_cache

LABELLED, POOL, SEED = 8_000, 3_000, 5
ROUNDS, SURE, PER_ROUND = 3, 0.97, 1_000
REJECT = 0.5
BITS = 18
#: Rows whose features are counted at a time while the text view is fitted.
BLOCK = 500
#: Tokens that one Python worker remembers before it starts afresh.
VOCABULARY = 150_000
FEWEST, STRAY = 5, 4.0
HELD_OUT = 4  # one labelled document in four calibrates
QUESTIONS = ("low", "toxic")
N_META = 12 + 64 + 32


def _slot(kind: str, value: str) -> int:
    """Feature number from 1 on (0 is the bias)."""
    return 1 + zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % ((1 << BITS) - 1)


class Tokens(dict):
    """token -> (word's number, its beginning's number, shape); bounded."""

    def __missing__(self, token: str) -> tuple[int, int, str]:
        if len(self) >= VOCABULARY:
            self.clear()
        word = "".join(c for c in token if c.isalpha()).lower()
        shape = ("A" if token.isupper() and len(word) > 1 else "a" if word else "") + "".join(sorted({c for c in token if not c.isalnum()}))[:4] + ("9" if any(c.isdigit() for c in token) else "")
        found = self[token] = (_slot("w", word), _slot("b", word[:5]), shape) if word else (0, 0, shape)
        return found


def text_features(text: str | None, tokens: Tokens) -> np.ndarray:
    """Sorted distinct feature numbers of the text view."""
    words = (text or "").split()
    counts = Counter(words)
    found, shapes = {0}, Counter()
    for token, n in counts.items():
        word, begin, shape = tokens[token]
        found.add(word)
        found.add(begin)
        shapes[shape] += n
    for shape, n in shapes.items():
        found.add(_slot("s", f"{shape}:{min(9, int(math.log2(len(words) / n)))}"))
    if words:
        found.add(_slot("r", str(int(8 * len(counts) / len(words)))))
        again = sum(map(str.__eq__, words, words[1:]))
        found.add(_slot("q", str(int(8 * again / len(words)))))
    return np.fromiter(sorted(found), np.int32, len(found))


def metadata_features(text: str | None, lang: str | None, source: str | None) -> np.ndarray:
    text = text or ""
    n = max(1, len(text))
    lines = text.split("\n")
    data = text.encode("utf-8", "surrogatepass")
    signs = len(data) - len(data.translate(None, b"#*$%&|<>"))
    marks = len(data) - len(data.translate(None, b"!?"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    stops = len(data) - len(data.translate(None, b".,"))
    out = np.zeros(N_META, np.float32)
    out[:12] = [1, math.log1p(n) / 10, math.log1p(len(lines)) / 5, math.log1p(n / len(lines)) / 8, min(1, 10 * signs / n), min(1, 20 * marks / n), min(1, 10 * digits / n), min(1, 4 * upper / n), min(1, 20 * stops / n), 1 - len(set(lines)) / len(lines), float(signs == 0), float(upper > n / 2)]
    out[12 + zlib.crc32(f"{source}".encode("utf-8", "surrogatepass")) % 64] = 1
    out[76 + zlib.crc32(f"{lang}".encode("utf-8", "surrogatepass")) % 32] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(dot, back, n: int, y: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """Logistic regression by adaptive gradient steps; the classes weigh the same at the square root of their odds."""
    weight = np.where(y > 0, math.sqrt(max(1.0, (y <= 0).sum() / max(1, (y > 0).sum()))), 1.0)
    w, total = np.zeros(n), np.full(n, 1e-8)
    for _ in range(steps):
        g = back(weight * (_sigmoid(dot(w)) - y)) / weight.sum() + l2 * w
        total += g * g
        w -= 0.3 * g / np.sqrt(total)
    return w


def _blocks(rows: list[np.ndarray], y: np.ndarray, common: np.ndarray | None = None) -> Iterator[tuple]:
    """(which of them are common, features, number and label of the row of each) of ``BLOCK`` rows at a time."""
    for a in range(0, len(rows), BLOCK):
        some = rows[a : a + BLOCK]
        flat, count = np.concatenate(some), [len(r) for r in some]
        owner = np.repeat(np.arange(a, a + len(some), dtype=np.int32), count)
        yield None if common is None else common[flat], flat, owner, y[owner]


def fit_text(rows: list[np.ndarray], y: np.ndarray, steps: int = 150) -> np.ndarray:
    """Weights of the text view (2**BITS of them).

    Only features whose documents' labels stray from the prior by ``STRAY`` standard deviations get a weight: with
    hundreds of thousands of rare words, the rest would let the model learn its documents by heart.
    """
    n, ones = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS)
    for _, flat, _, label in _blocks(rows, y):
        n += np.bincount(flat, minlength=1 << BITS)
        ones += np.bincount(flat, label, 1 << BITS)
    prior = y.mean()
    stray = (ones - n * prior) / np.sqrt(n * prior * (1 - prior) + 1e-9)
    common = (n >= FEWEST) & (abs(stray) >= STRAY)
    common[0] = True
    number = np.cumsum(common, dtype=np.int32) - 1
    parts = [(number[flat[keep]], owner[keep]) for keep, flat, owner, _ in _blocks(rows, y, common)]
    at, owner = (np.concatenate(x, dtype=np.intp) for x in zip(*parts, strict=True))
    del parts
    each = np.empty(len(at))  # one array for all steps
    size = int(common.sum())
    w = _descend(lambda w: np.bincount(owner, np.take(w, at, out=each, mode="clip"), len(rows)), lambda r: np.bincount(at, np.take(r, owner, out=each, mode="clip"), size), size, y, 1e-4, steps)
    out = np.zeros(1 << BITS, np.float32)
    out[common] = w
    return out


def fit_metadata(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    return _descend(lambda w: x @ w, lambda r: x.T @ r, x.shape[1], y, 1e-4, steps).astype(np.float32)


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is the probability; Newton's method, targets drawn in as Platt has it."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([score, np.ones_like(score)], 1)
    w = np.array([1.0, math.log((n1 + 1) / (n0 + 1))])
    loss = lambda w: float((np.logaddexp(0, x @ w) - t * (x @ w)).sum())
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - t))
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-6:
            break
    return max(float(w[0]), 1e-3), float(w[1])


@dataclass
class Model:
    """One question's two views and their calibration."""

    text: np.ndarray
    meta: np.ndarray
    of_text: tuple[float, float]
    of_meta: tuple[float, float]
    prior: float
    of_both: tuple[float, float] = (1.0, 0.0)
    added: list[tuple[int, int]] = field(default_factory=list)

    def odds(self, text_score, meta_score):
        """Calibrated log-odds of both views together."""
        (a, b), (c, d), (e, f) = self.of_text, self.of_meta, self.of_both
        return e * (a * text_score + b + c * meta_score + d - self.prior) + f


def text_scores(rows: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    return np.array([w[r].sum() for r in rows])


def co_train(rows: list[np.ndarray], meta: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = ROUNDS) -> Model | None:
    """y: 1, 0, or -1 for the pool. held: labelled rows that calibrate. None without rows of both kinds in either part."""
    fit, pool = (y >= 0) & ~held, np.flatnonzero(y < 0)
    check = (y >= 0) & held
    if min((y[fit] == 1).sum(), (y[fit] == 0).sum(), (y[check] == 1).sum(), (y[check] == 0).sum()) < 1:
        return None
    base, check = np.flatnonzero(fit), np.flatnonzero(check)
    given: dict[str, dict[int, int]] = {"text": {}, "meta": {}}
    prior = math.log(((y[base] == 1).sum() + 1) / ((y[base] == 0).sum() + 1))
    added = []
    for r in range(rounds + 1):
        views = {}
        for view in ("text", "meta"):
            own = np.concatenate([base, np.array(sorted(given[view]), int)])
            target = np.concatenate([y[base], [given[view][i] for i in sorted(given[view])]]).astype(float)
            if view == "text":
                w = fit_text([rows[i] for i in own], target)
                score = text_scores(rows, w)
            else:
                w = fit_metadata(meta[own], target)
                score = meta @ w
            views[view] = (w, score, platt(score[check], y[check].astype(float)))
        if r == rounds:
            break
        for view, other in (("text", "meta"), ("meta", "text")):
            _, score, (a, b) = views[view]
            p = _sigmoid(a * score[pool] + b)
            for sure, label in ((p, 1), (1 - p, 0)):
                best = np.argsort(-sure, kind="stable")[:PER_ROUND]
                for k in best[sure[best] >= SURE]:
                    given[other].setdefault(int(pool[k]), label)
        added.append((len(given["text"]), len(given["meta"])))
    (wt, st, ct), (wm, sm, cm) = views["text"], views["meta"]
    model = Model(wt, wm, ct, cm, prior, added=added)
    model.of_both = platt(model.odds(st[check], sm[check]), y[check].astype(float))
    return model


def _featured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_cache("quality_classifier")
    tokens = Tokens()
    for pdf in batches:
        text = [text_features(t, tokens).tobytes() for t in pdf["text"]]
        meta = [metadata_features(*x).tobytes() for x in zip(pdf["text"], pdf["lang"], pdf["source"], strict=True)]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "low": pdf["low"], "toxic": pdf["toxic"], "text": text, "meta": meta})


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL, rounds: int = ROUNDS) -> dict[str, Model | None]:
    """The models, from at most ``labelled`` labelled and ``pool`` unlabelled documents."""
    order = F.xxhash64(F.lit(SEED), "doc_id")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg((1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    known = marks.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled)
    free = ids.join(marks.select("doc_id"), "doc_id", "left_anti").orderBy(order, "doc_id").limit(pool)
    none = F.lit(None).cast("int")
    sample = known.unionByName(free.select("doc_id", none.alias("low"), none.alias("toxic")))
    rows = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])  # labelled + pool rows at most
    try:
        return _models(rows.mapInPandas(_featured, "doc_id long, low int, toxic int, text binary, meta binary").toArrow(), rounds)
    finally:  # the driver keeps only the models
        gc.collect()
        released()


def _models(table: pa.Table, rounds: int) -> dict[str, Model | None]:
    """The models, from rows of ``_featured``; the table is let go before they are fitted."""
    if not len(table):
        return {q: None for q in QUESTIONS}
    ids = table["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    seen = np.zeros(1 << BITS, np.int32)
    for row in _arrays(table["text"], np.int32):
        seen[row] += 1
    text = [row[seen[row] >= FEWEST] for row in _arrays(table["text"], np.int32)]  # rarer ones get no weight
    text = [text[i] for i in order]
    meta = np.concatenate(list(_arrays(table["meta"], np.float32))).reshape(len(ids), N_META)[order].astype(float)
    held = np.array([zlib.crc32(str(i).encode()) % HELD_OUT == 0 for i in ids[order]])
    y = {q: table[q].fill_null(-1).to_numpy()[order].astype(int) for q in QUESTIONS}
    del table
    released()
    return {q: co_train(text, meta, y[q], held, rounds) for q in QUESTIONS}


def _arrays(column: pa.ChunkedArray, kind: type) -> Iterator[np.ndarray]:
    """The numbers of each binary value, in place."""
    for chunk in column.chunks:
        for value in chunk:
            yield np.frombuffer(value.as_buffer(), kind)


def score(docs: DataFrame, models: dict[str, Model | None], reject: float = REJECT) -> DataFrame:
    """docs with p_low, p_toxic and kept; columns of docs with these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(models)  # 2**BITS weights a question, whatever the input
    new = ("p_low", "p_toxic", "kept")
    names = [c for c in docs.columns if c not in new]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("p_low", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("quality_classifier")
        tokens, models = Tokens(), sent.value
        for pdf in batches:
            p = {q: np.zeros(len(pdf)) for q in QUESTIONS}
            for i, x in enumerate(zip(pdf["text"], pdf["lang"], pdf["source"], strict=True)):
                text, meta = text_features(x[0], tokens), metadata_features(*x)
                for q, m in models.items():
                    if m is not None:
                        p[q][i] = m.odds(float(m.text[text].sum()), float(meta @ m.meta))
            for q, m in models.items():
                if m is not None:
                    p[q] = _sigmoid(p[q])
            yield pdf[names].assign(p_low=p["low"], p_toxic=p["toxic"], kept=(p["low"] < reject) & (p["toxic"] < reject))

    return map_batches(docs.select(*(F.col(f"`{c}`") for c in names)), run, schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs with p_low, p_toxic and kept, by models fitted to these labels (doc_id, quality, toxic)."""
    return score(docs, fit(docs, labels, **options))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scored = classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", F.round("p_low", 6).alias("p_low"), F.round("p_toxic", 6).alias("p_toxic"), "kept")


QUERIES = {"op8_quality_classifier": op8_quality_classifier}
ORACLES: dict[str, str] = {}
