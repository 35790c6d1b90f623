"""Scalar and array helpers on columns. All of them are built-in expressions, inside code generation where Spark has it."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def paste(sep: str, *cols: str | Column) -> Column:
    """Joins columns as text; a null is written NA (``concat_ws`` would skip it)."""
    return F.concat_ws(sep, *(F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols))


def sub_first(col: str | Column, pattern: str, replacement: str = "") -> Column:
    """Replaces the first match only."""
    return F.regexp_replace(_col(col), f"(?s)^(.*?)(?:{pattern})", f"$1{replacement}")


def strip_ends(col: str | Column, first: int, last: int) -> Column:
    """Without the first and the last items; empty when nothing is left."""
    c = _col(col)
    return F.when(F.length(c) > first + last, F.substring(c, F.lit(first + 1), F.length(c) - first - last)).otherwise("")


def subseq_safe(col: str | Column, start: Column | int, end: Column | int) -> Column:
    """Items start to end (from 1, both included), with the ends drawn in; empty when end < start."""
    c = _col(col)
    a = F.greatest(F.lit(1), _int(start))
    b = F.least(F.length(c), _int(end))
    return F.when(b >= a, F.substring(c, a, b - a + 1)).otherwise("")


def sentence_case(col: str | Column) -> Column:
    c = _col(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))


def basename(col: str | Column) -> Column:
    return F.regexp_extract(_col(col), "([^/]*)$", 1)


def dirname(col: str | Column) -> Column:
    return F.regexp_extract(_col(col), "^(.*)/[^/]*$", 1)


def extension(col: str | Column) -> Column:
    return F.regexp_extract(_col(col), r"\.([A-Za-z0-9]+)$", 1)


def half_even(col: str | Column, digits: int = 0) -> Column:
    """Rounds as IEC 60559 does: a half goes to the even neighbour."""
    return F.bround(_col(col), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, null for an empty whole."""
    return F.when(whole != 0, F.round(100.0 * part / whole, digits))


def approximate_pattern(pattern: str, most: int) -> str:
    """A regular expression of all texts that differ from the pattern in ``most`` letters at most.

    Branches part at each letter into "as in the pattern" and "any other", so no text matches two of them and a search
    gives up at its (most + 1)-th difference.
    """

    @cache
    def rest(i: int, left: int) -> str:
        if i == len(pattern):
            return ""
        here = re.escape(pattern[i])
        if left == 0:
            return re.escape(pattern[i:])
        return f"(?:{here}{rest(i + 1, left)}|(?!{here})(?s:.){rest(i + 1, left - 1)})"

    return rest(0, most)


def approximate_positions(col: str | Column, pattern: str, most: int = 2, first: int = 1) -> Column:
    """Starts (from 1) of all full-length matches with ``most`` substitutions at most, not before ``first``.

    The text is split before each match, overlapping ones too; the lengths of the pieces add up to the starts. A match at
    the very begin splits nothing off and is looked for by itself. Halves of a surrogate pair begin no match.
    """
    c = _col(col)
    found = approximate_pattern(pattern, most)
    pieces = F.split(c, f"(?=(?![\\x{{DC00}}-\\x{{DFFF}}]){found})", -1)

    def add(state: Column, piece: Column) -> Column:
        return F.struct((state["at"] + F.length(piece)).alias("at"), F.concat(state["hits"], F.array(state["at"])).alias("hits"))

    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("hits"))
    starts = F.aggregate(pieces, zero, add, lambda s: s["hits"])
    starts = F.when(c.rlike(f"^{found}"), starts).otherwise(F.slice(starts, F.lit(2), F.greatest(F.lit(0), F.size(starts) - 1)))
    return F.filter(starts, lambda p: p >= first) if first > 1 else starts


def position_bucket(col: str | Column, size: int) -> Column:
    """Number (from 1) of the fixed-width tile that holds a position from 1."""
    return F.ceil(_col(col) / F.lit(size)).cast("long")


def has_bit(col: str | Column, bit: int) -> Column:
    return _col(col).bitwiseAND(F.lit(bit)) != 0


def finite(col: str | Column) -> Column:
    c = _col(col).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def url_safe_digest(col: str | Column, n_bytes: int = 24) -> Column:
    """The first bytes of the SHA-512 of a text, in URL-safe base64 without padding."""
    digest = F.unhex(F.substring(F.sha2(_col(col), 512), 1, 2 * n_bytes))
    return F.regexp_replace(F.translate(F.base64(digest), "+/", "-_"), "=+$", "")


def codons(col: str | Column) -> Column:
    """The complete triplets of a sequence, in order."""
    return F.regexp_extract_all(_col(col), F.lit("(?s)..."), F.lit(0))


def digit_total(n: Column) -> Column:
    """Number of digits written when counting from 1 to n (closed form over the powers of ten)."""
    powers = F.transform(F.sequence(F.lit(0), F.lit(17)), lambda k: F.pow(F.lit(10.0), k).cast("long"))
    return F.aggregate(powers, F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(F.lit(0).cast("long"), n.cast("long") - p + 1))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(c: Column | int) -> Column:
    return F.lit(c) if isinstance(c, int) else c
