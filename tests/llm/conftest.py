import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of texts (ids count from 0) or of (doc_id, text, lang, source) rows."""

    def make(rows, parts=3):
        rows = [r if isinstance(r, tuple) else (i, r, "en", f"s{i % 3}") for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls in each column, empty and white texts, a repeated row, a very long text, a text of one long word."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))
    return docs_of(
        [
            (1, "plain words of a text", "en", "a"), (1, "plain words of a text", "en", "a"), (2, None, "en", "a"), (3, "", "en", None), (4, " \n\t ", None, "b"),
            (None, "a text without an id", "en", "b"), (5, long, "en", "b"), (6, "x" * 50_000, "de", "c"), (7, "Ünïcode ſ 日本 😀 text", None, None), (8, None, None, None),
        ]
    )


CLASHES = ("kept", "size", "target", "shard", "n_words", "n_cut", "is_copy", "base", "spans", "p_low", "p_toxic", "digest", "h", "key", "rep", "component_id", "piece_ids", "decoded", "_text", "_copy", "blocks", "words", "quota", "level")


@pytest.fixture(scope="session")
def clashing(odd):
    """odd with extra columns of names that the operators use themselves."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def passages():
    """Deterministic prose: prose(seed, n) are n words."""
    import random

    def prose(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))

    return prose
