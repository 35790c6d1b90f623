"""Token counts of a byte-level BPE vocabulary by dynamic programming over a trie of pre-tokens.

The text is cut where a space before a visible character begins a pre-token of its own; the distinct pieces between such
cuts are cut further by the vocabulary's pattern, the distinct pre-tokens of a batch are put into a trie (sorted, walked
depth-first), each shared prefix's forward state is computed once, and the count at a pre-token's last node is stored.
The public vocabularies are merge ranks, not unigram models: a state is the last token of the prefix's encoding with its
number of tokens (``bpe_trie``), since unigram scores would count other tokens than the vocabulary's encoder makes.

Nulls and empty texts count 0 tokens. Special tokens' strings are ordinary text. Repeated rows are counted each for itself;
a text has one encoding, so there are no ties (of two possible merges the lower rank goes first, then the left one).
Counts equal those of the tiktoken library.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_trie import TrieBpe
from .common import documents, map_batches, small_batches, worker_cache

VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: White space as in Unicode's property (the pattern's \s).
_S = r"\t-\r \x85\xa0  -     　"
#: The pattern of the vocabulary's pre-tokens; a fixed value, with \s written out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
#: Pieces and pre-tokens whose counts one worker remembers before it starts afresh.
REMEMBERED = 400_000


class TokenCounter:
    """Counts the tokens of texts; vocabulary: a tiktoken rank file's bytes."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.trie = TrieBpe(ranks)
        self.pretoken = regex.compile(PATTERN)
        self.doubled = regex.compile(rf" [{_S}]")
        self.cut = regex.compile(rf" (?=[^{_S}])")
        self.known: dict[str, int] = {}
        self.terminal: dict[bytes, int] = {}

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that pre-tokens don't cross: cut before each space that a visible character follows."""
        parts = self.cut.split(text) if self.doubled.search(text) or text[-1] == " " else text.split(" ")
        return [*([parts[0]] if parts[0] else []), *(" " + p for p in parts[1:])]

    def count(self, texts: Iterable[str | None]) -> list[int]:
        block = [self.pieces(t) if t else [] for t in texts]
        new = set().union(*block).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED and self.known:
            self.known.clear()
            self.terminal.clear()
            new = set().union(*block)
        found = {p: [t.encode("utf-8", "surrogatepass") for t in self.pretoken.findall(p)] for p in new}
        self.terminal |= self.trie.counts(sorted(set().union(*found.values()).difference(self.terminal)))
        for piece, pretokens in found.items():
            self.known[piece] = sum(map(self.terminal.__getitem__, pretokens))
        get = self.known.__getitem__
        return [sum(map(get, pieces)) for pieces in block]


def _counter(vocabulary: bytes) -> TokenCounter:
    """One counter a worker process, with the pre-tokens it has met."""
    counters, key = worker_cache("token_counts"), hash(vocabulary)
    if key not in counters:
        counters.clear()
        counters[key] = TokenCounter(vocabulary)
    return counters[key]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY_FILE, text_col: str = "text", out_col: str = "n_tokens", keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs (or its columns ``keep``) with the number of tokens of text_col in out_col, which is replaced if it exists."""
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # about 1 MB, whatever the input
    names = [c for c in (docs.columns if keep is None else keep) if c != out_col]
    rows = docs.select(*(F.col(f"`{c}`") for c in [*names, *([text_col] if text_col not in names else [])]))
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(out_col, T.LongType())])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(sent.value)
        for pdf in batches:
            out: list[int] = []
            for at in range(0, len(pdf), 500):
                out += counter.count(pdf[text_col].iloc[at : at + 500])
            yield pdf[names].assign(**{out_col: out})

    return map_batches(rows, run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens of every document."""
    small_batches(spark)
    return token_counts(documents(spark, sf_dir).select(F.col("doc_id"), F.col("text")), keep=("doc_id",))


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
