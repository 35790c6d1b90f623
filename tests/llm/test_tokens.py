import base64
import random

import pytest

from seqloom.llm import sentencepiece_codec as codec
from seqloom.llm import token_counts as tokens

sentencepiece = pytest.importorskip("sentencepiece")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    letters = "abcdefgh eéñ \n.,;0123ABC日本▁  ing\t\x1c'"
    return ["", " ", "  a", "a  b ", "it's we'll", "def f(x):\n    return  x\n", "▁x ▁", "a" * 3000, "😀 日本語"] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 150))) for _ in range(800)]


def test_ids_are_the_librarys(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=codec.MODEL)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r for r in codec.decode(codec.encode(df)).collect()}
    assert all(got[i].piece_ids == sp.encode(t) and got[i].decoded == sp.decode(sp.encode(t)) for i, t in enumerate(texts))


def test_counts_are_the_librarys(spark, texts):
    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.VOCABULARY_FILE, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert all(r.n_tokens == len(enc.encode_ordinary(r.text)) for r in tokens.token_counts(df).collect())


def test_odd_rows(odd, clashing, none):
    for df in (odd, clashing):
        rows = codec.digest(df).collect()
        assert len(rows) == odd.count() and all(r.round_trip for r in rows if r.doc_id not in (2, 8))
        counted = tokens.token_counts(df).collect()
        assert all(r.n_tokens == 0 for r in counted if not r.text) and len(counted) == len(rows)
    assert codec.digest(none).count() == tokens.token_counts(none).count() == 0


def test_caches_stay_bounded():
    with open(codec.MODEL, "rb") as f:
        c = codec.PieceCodec(f.read(), remember=50)
    for k in range(20):
        list(c.encode([" ".join(f"word{k}x{i}" for i in range(40))]))
        assert len(c.known) <= 50


def test_column_names_with_dots_and_repeated_rows(spark, docs_of):
    from pyspark.sql import functions as F

    from seqloom.llm import line_dedup, quality_classifier, sentencepiece_codec, token_counts

    docs = docs_of([(1, "a text", "en", "s"), (1, "a text", "en", "s")]).withColumn("a.b", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    coded = sentencepiece_codec.round_trips(docs)
    for out in (token_counts.token_counts(docs), coded, sentencepiece_codec.decode(sentencepiece_codec.encode(docs)), line_dedup.line_dedup(docs), quality_classifier.classify(docs, labels)):
        rows = out.collect()
        assert len(rows) == 2 and rows[0] == rows[1] and all(r["a.b"] == 1 and r.text == "a text" for r in rows)


def test_codec_remembers_no_more_than_told(passages):
    """Caches stay within their bound, whatever a batch or one text holds; ids are those of a codec that forgets nothing."""
    import numpy as np

    from seqloom.llm import sentencepiece_codec as sc

    with open(sc.MODEL, "rb") as f:
        model = f.read()
    texts = [*(passages(seed, 400) for seed in range(20)), passages(99, 6_000), "", None, " a  b ", "Ünï 日本 😀"]
    small, large = sc.PieceCodec(model, 1_000), sc.PieceCodec(model)
    got, want = list(small.encode(texts)), list(large.encode(texts))
    assert len(got) == len(texts) and all(map(np.array_equal, got, want))
    assert len(large.known) > 5_000 and len(small.known) <= 1_000 and len(small.trie._fits) <= 1_000
    assert [small.decode(ids) for ids in got] == [t or "" for t in texts]


def test_pairs_hold_the_tokens_of_the_ranks():
    from seqloom.llm.bpe_trie import TrieBpe

    ranks = {t: i for i, t in enumerate(["lo", "low", "er", "lower", "st"])}
    trie = TrieBpe(ranks)
    assert [t for _, t in trie.tokens(["lower", "lowest", "slower"])] == [["lower"], ["low", "e", "st"], ["s", "lower"]]
    own = set(map(id, ranks))
    assert all(id(t) in own for pair in trie._fits for t in pair if t in ranks)
