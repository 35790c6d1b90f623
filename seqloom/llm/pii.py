"""Personal data: overlapping candidate spans, boosted trees over format and context, calibrated thresholds.

All on DataFrame functions. High-recall generators (regular expressions, possessive or anchored, so linear in the text)
propose spans of four kinds of personal data and of secrets (keys and tokens). The base generators' matches that pass their checks always stay. The other candidates (local
phone numbers, cards in groups or beside each other, IPv6 addresses, obfuscated addresses, long mixed strings, and base
matches that fail) get a score by
gradient-boosted trees over features of the span and of the 30 characters before it; those above their kind's threshold
that overlap no base span are added. Trees are small, trained here on seeded, generated spans (``training_spans``) and
compiled to CASE expressions; a kind's threshold is the lowest score with 99% precision on generated spans held out.

Nulls: a null text counts as empty and has no spans. Positions are code points, the end exclusive. Rows are judged each for
itself, repeated ones too; matches that tie for a place can't be, since a generator's are leftmost and don't overlap, and
equal spans of two generators count once. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

KINDS = ("email", "ip", "card", "phone")
#: With what only the trees can add.
ALL_KINDS = (*KINDS, "secret")
#: Base patterns; starts are anchored to the begin of a run or to the last match's end, which finds the same matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further generators.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-]|00[0-9]{1,3}[ .-][0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}",
}
#: What a text must contain for a kind's generators to run at all.
NEEDS = {"email": r"@|[\[(] ?(?:at|AT) ?[\])]", "ip": r"[0-9A-Fa-f][.:][0-9A-Fa-f]", "card": "[0-9]", "phone": "[0-9]", "secret": "[0-9]"}
AROUND = 30
PRECISION = 0.99
TREES, RATE, DEPTH = 40, 0.3, 2
SEED = 7


# Features: the same on columns and in Python, for the trees' training.


@dataclass(frozen=True)
class Feature:
    name: str
    column: Callable[[str, Column, Column, Column], Column]
    python: Callable[[str, str, str, str], float]


def _has(name: str, part: str, pattern: str) -> Feature:
    at = {"value": 0, "before": 1, "after": 2}[part]
    compiled = re.compile(pattern)
    return Feature(name, lambda kind, *parts: parts[at].rlike(pattern).cast("int"), lambda kind, *parts: float(bool(compiled.search(parts[at]))))


def _left(name: str, drop: str) -> Feature:
    """Number of characters of the value that are not in a class."""
    compiled = re.compile(drop)
    return Feature(name, lambda kind, v, b, a: F.length(F.regexp_replace(v, drop, "")), lambda kind, v, b, a: float(len(compiled.sub("", v))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).try_cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits))), F.lit(0), add) % 10 == 0, F.lit(False))


def luhn_python(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return bool(digits) and total % 10 == 0


FEATURES = (
    *(Feature(f"is_{k}", lambda kind, v, b, a, k=k: F.lit(int(kind == k)), lambda kind, v, b, a, k=k: float(kind == k)) for k in ALL_KINDS),
    _left("n_digits", "[^0-9]"),
    _left("n_separators", "[^ .()/_-]"),
    _left("n_colons", "[^:]"),
    Feature("n_chars", lambda kind, v, b, a: F.length(v), lambda kind, v, b, a: float(len(v))),
    Feature("luhn", lambda kind, v, b, a: luhn(F.substring(_digits(v), 1, 40)).cast("int"), lambda kind, v, b, a: float(luhn_python(re.sub("[^0-9]", "", v)[:40]))),
    _has("bracketed_at", "value", r"[\[(] ?(?:at|AT) ?[\])]"),
    _has("bracketed_dot", "value", r"[\[(] ?(?:dot|DOT) ?[\])]"),
    _has("local_phone", "value", r"^\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$"),
    _has("area_code", "value", r"^\(?[2-9][0-9]{2}\)?"),
    _has("high_part", "value", r"(?:^|\.)(?:2[6-9][0-9]|25[6-9]|[3-9][0-9]{2}|[0-9]{4,})(?:\.|$)"),
    _has("glued_before", "before", r"[A-Za-z0-9_=\"'#/.-]$"),
    _has("glued_after", "after", r"^[A-Za-z0-9_\"'/-]"),
    _has("says_phone", "before", r"(?i)\b(?:tel|telephone|phone|call|fax|mobile|cell|dial)\b"),
    _has("says_card", "before", r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|paid)\b"),
    _has("says_address", "before", r"(?i)\b(?:ip|ipv6|host|server|address|from)\b"),
    _has("says_mail", "before", r"(?i)\b(?:mail|email|e-mail|contact|write|reach)\b"),
    _has("hexadecimal", "value", r"^(?:[0-9a-f]{20,}|[0-9A-F]{20,})$"),
    _has("path_like", "value", r"/.*/|[_-].*[_-]"),
    _has("says_secret", "before", r"(?i)(?:token|secret|passw|pwd|api|key|auth|bearer|credential)[a-z_]*[\"']?\s*(?:[:=]|is)?\s*[\"']?$"),
    _has("says_number", "before", r"(?i)\b(?:order|invoice|id|no|number|version|part|isbn|ref|serial|ticket)\b"),
)


# Training on generated spans.


def training_spans(n: int, seed: int) -> list[tuple[str, str, str, str, int]]:
    """(kind, value, before, after, whether it is personal data) of n generated candidates."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    plain = ["the ", "and then ", "it was ", "of ", "", "see ", "in the end "]
    numbers = ["order no ", "invoice ", "id ", "version ", "part number ", "ref: ", "serial "]

    def card(valid: bool) -> str:
        while True:
            d = rng.choice("3456") + digits(15)
            if luhn_python(d) == valid:
                return d

    out = []
    for _ in range(n):
        kind, good = rng.choice(ALL_KINDS), rng.random() < 0.5
        before, after = rng.choice(plain), rng.choice([" ", ".", ",", " and", ""])
        if kind == "phone":
            area = rng.choice("23456789" if good else "01234567") + digits(2)
            sep = rng.choice("-. ") if good else rng.choice("-.")
            value = f"({area}) {digits(3)}-{digits(4)}" if good and rng.random() < 0.5 else f"{area}{sep if sep != ' ' else '-'}{digits(3)}{sep}{digits(4)}"
            if good:
                before = rng.choice(["call ", "phone: ", "tel. ", "mobile ", *plain[:2]])
            else:
                before = rng.choice([*numbers, "x-", "#", "a/", '"'])
                after = rng.choice(["-" + digits(2), "/a", " ", '"'])
        elif kind == "card":
            sep = rng.choice("./_")
            d = card(good)
            value = sep.join(d[i : i + 4] for i in range(0, 16, 4)) if good or rng.random() < 0.5 else d
            before = rng.choice(["card ", "visa: ", *plain]) if good else rng.choice([*numbers, *plain, "card "])
        elif kind == "secret":
            letters = rng.choice(["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789+/"])
            value = "".join(rng.choice(letters) for _ in range(rng.choice([24, 32, 40, 64])))
            said = rng.choice(["token", "api_key", "secret", "password", "Authorization", "ACCESS_KEY", "client_secret"])
            if good:
                before = rng.choice(plain) + said + rng.choice([" = ", ": ", "=", '": "', ' = "', " is "])
                after = rng.choice(['"', " ", ";", "", "!"])
            else:
                before = rng.choice([*numbers, *plain, "commit ", "sha256 ", "etag: ", "build "])
                if rng.random() < 0.5:
                    value = rng.choice(["section-", "img/", "chapter_"]) + "-".join(rng.choice(["alpha", "v2", "page", "2024", "draft", "index"]) for _ in range(4))
        elif kind == "ip":
            if good:
                value = ":".join(f"{rng.randrange(65536):x}" for _ in range(8))
                before = rng.choice(["ip ", "host ", "from ", *plain])
            elif rng.random() < 0.5:
                value = f"{rng.randrange(256, 9999)}.{digits(rng.randint(1, 3))}.{digits(2)}.{digits(2)}"
                before = rng.choice([*numbers, *plain])
            else:
                value = ":".join(digits(2) for _ in range(6))
                before = rng.choice(["at ", "mac ", *plain])
        else:
            name, host = rng.choice(["jo", "anna.k", "info", "m_lee"]), rng.choice(["example", "mail", "web-host"])
            if good:
                value = f"{name} {rng.choice(['(at)', '[at]', '( at )'])} {host} {rng.choice(['[dot] ', '(dot) ', '.'])}com".replace(" .com", ".com")
                before = rng.choice(["mail ", "contact: ", "write to ", *plain])
            else:
                value = f"{rng.choice(['meet', 'noon', 'stop'])} (at) {rng.choice(['gate', 'home', 'ten'])}.{rng.choice(['We', 'Then', '30', 'The'])}"
                before = rng.choice(plain)
        out.append((kind, value, before, after, int(good)))
    return out


def _matrix(spans: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([[f.python(*s[:4]) for f in FEATURES] for s in spans]), np.array([s[4] for s in spans], float)


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> tuple | float:
    """A tree for gradients g and curvatures h: (feature, threshold, low side, high side) or a leaf's value."""
    leaf = float(g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 20:
        return leaf
    best, parent = (1e-6, None, None), g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        for t in (values[:-1] + values[1:]) / 2 if len(values := np.unique(x[:, f])) > 1 else ():
            low = x[:, f] < t
            gain = g[low].sum() ** 2 / (h[low].sum() + 1) + g[~low].sum() ** 2 / (h[~low].sum() + 1) - parent
            if gain > best[0]:
                best = (gain, f, float(t))
    if best[1] is None:
        return leaf
    low = x[:, best[1]] < best[2]
    return best[1], best[2], _split(x[low], g[low], h[low], depth - 1), _split(x[~low], g[~low], h[~low], depth - 1)


def _value(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] < tree[1], _value(tree[2], x), _value(tree[3], x))


@cache
def trained(seed: int = SEED) -> tuple[tuple, dict[str, float]]:
    """The trees and each kind's threshold on their sum (log-odds)."""
    x, y = _matrix(training_spans(1200, seed))
    score, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(_split(x, y - p, p * (1 - p), DEPTH))
        score += RATE * _value(trees[-1], x)
    held = training_spans(1200, seed + 1)
    x, y = _matrix(held)
    score = RATE * sum(_value(t, x) for t in trees)
    kinds, thresholds = np.array([s[0] for s in held]), {}
    for kind in ALL_KINDS:
        s, good = score[kinds == kind], y[kinds == kind]
        order = np.argsort(-s)
        precision = np.cumsum(good[order]) / np.arange(1, len(order) + 1)
        fine = np.flatnonzero(precision >= PRECISION)
        thresholds[kind] = max(0.0, float(s[order][fine[-1]])) if len(fine) else math.inf
    return tuple(trees), thresholds


def scored(kind: str, value: Column, before: Column, after: Column, trees: tuple) -> Column:
    """The trees' sum as one expression."""

    def case(tree: tuple | float) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        return F.when(FEATURES[tree[0]].column(kind, value, before, after) < tree[1], case(tree[2])).otherwise(case(tree[3]))

    return RATE * reduce(lambda a, b: a + b, map(case, trees))


# Candidates.

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places: the lengths of the parts between them add up to the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("value")))

    def put(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(F.filter(pairs, lambda x: x["value"].isNotNull()), zero, put, lambda s: s["spans"])


def passes(kind: str, value: Column) -> Column:
    """The base generators' checks."""
    n = F.length(_digits(value))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, "\\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(value))).otherwise(False)
    return n.between(9, 15)


def passing(kind: str) -> Callable[[Column], Column]:
    return lambda x: passes(kind, x["value"])


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with ``base`` and ``spans``: arrays of (kind, start, end, value), by kind as listed, then start.

    spans holds the base spans and those that the trees add. Columns of docs with these names are replaced.
    """
    trees, thresholds = trained()
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = "_"
    while any(c.lower().startswith(own) for c in docs.columns):  # helper columns get names that docs doesn't have
        own = "_" + own
    cols, none = {}, F.array().cast(SPAN)
    for kind in ALL_KINDS:
        needed = text.rlike(NEEDS[kind])
        if kind in KINDS:
            cols[f"{own}all_{kind}"] = F.when(needed, matches(text, BASE[kind])).otherwise(none)
        cols[f"{own}more_{kind}"] = F.when(needed & text.rlike(MORE[kind]), matches(text, MORE[kind])).otherwise(none)
    df = docs.drop("base", "spans").withColumns(cols)
    df = df.withColumns({f"{own}base_{k}": F.filter(f"{own}all_{k}", passing(k)) for k in KINDS})
    tagged = lambda kind, spans: F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
    df = df.withColumn("base", F.concat(*(tagged(k, F.col(f"{own}base_{k}")) for k in KINDS)))

    def added(kind: str) -> Column:
        def chosen(x: Column) -> Column:
            before = F.substring(text, F.greatest(F.lit(1), x["start"] + 1 - AROUND), F.least(F.lit(AROUND), x["start"]))
            after = F.substring(text, x["end"] + 1, F.lit(1))
            clear = ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
            return F.when(clear, scored(kind, x["value"], before, after, trees) >= thresholds[kind]).otherwise(False)

        spans = F.col(f"{own}more_{kind}")
        if kind in KINDS:
            fits = lambda x: (F.length(_digits(x["value"])) <= 19) if kind == "card" else F.lit(True)
            failed = F.filter(f"{own}all_{kind}", lambda x: ~passes(kind, x["value"]) & F.length(x["value"]).between(7, 64) & fits(x))
            spans = F.concat(spans, failed)
        return F.when(F.size(spans) > 0, F.filter(spans, chosen)).otherwise(none)

    df = df.withColumns({f"{own}added_{k}": added(k) for k in ALL_KINDS})
    by_start = lambda spans: F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"]))
    base_of = lambda k: F.col(f"{own}base_{k}") if k in KINDS else none
    all_of = lambda k: F.when(F.size(f"{own}added_{k}") > 0, by_start(F.concat(base_of(k), f"{own}added_{k}"))).otherwise(base_of(k))
    df = df.withColumn("spans", F.concat(*(tagged(k, F.array_distinct(all_of(k))) for k in ALL_KINDS)))
    return df.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans")), "base", "spans")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each span of the text replaced by its kind in brackets; overlapping spans become one, named by the first."""
    found = find(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    in_order = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def put(s: Column, x: Column) -> Column:
        gap = F.when(x["start"] >= s["at"], F.concat(F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], gap).alias("out"))

    clean = F.aggregate(in_order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("spans") > 0, clean).otherwise(F.col(text_col))).drop("base", "spans")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email to n_phone and base_sha256 (base spans), spans (all of the four kinds), secrets (keys and tokens), n_found (all of both)."""
    found = find(documents(spark, sf_dir).select("doc_id", "text"))
    of = lambda *kinds: lambda x: x["kind"].isin(*kinds)
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    spans, secrets = (joined(F.filter("spans", of(*kinds))) for kinds in (KINDS, ["secret"]))
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"), secrets.alias("secrets"), F.size("spans").cast("long").alias("n_found"))


QUERIES = {"op7_pii": op7_pii}
ORACLES: dict[str, str] = {}
