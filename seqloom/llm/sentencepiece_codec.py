"""SentencePiece encoding and decoding with a shared-prefix search over marked words.

Reads a SentencePiece BPE model with byte fallback as it is (nothing is trained). The text is marked as the model says
(a dummy prefix, spaces as U+2581) and cut before each run of marks; no token of the model crosses such a cut. The
distinct marked words of a batch are sorted into a trie and walked depth-first with shared forward states
(``bpe_trie``). The public model's scores are merge ranks, so the forward state is the last token of the prefix's
encoding rather than a sum of unigram log-probabilities, which would give other ids than the model's own.

Nulls and empty texts encode to no ids and decode to an empty text. Repeated rows are encoded each for itself. Ids, and texts decoded from them, equal those of
the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .bpe_trie import PAIRS, TrieBpe
from .common import documents, map_batches, released, small_batches, worker_cache

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Marked words whose ids one worker remembers before it starts afresh (about 200 bytes each). With fewer, its checked
#: pairs (about 120 bytes each) are no more, and blocks of words are a fifth at most.
REMEMBERED = 1_500_000
#: Words of a block that shares one trie.
BLOCK = 400_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        elif key & 7 in (1, 5):
            n = 8 if key & 7 == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n
        else:
            raise ValueError("not a SentencePiece model")


class PieceCodec:
    """Encoder and decoder of one model file (its bytes)."""

    def __init__(self, model: bytes, remember: int = REMEMBERED):
        self.remember = remember
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores, dummy, extra, escape, charsmap, kind = [], True, True, True, b"", 1
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif number == 3:
                spec = dict(_fields(value))
                dummy, extra, escape, charsmap = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)), spec.get(2, b"")
        if kind != 2 or charsmap or extra or not escape or USER in self.kinds:
            raise ValueError("only BPE models without normalisation rules and user-defined pieces are supported")
        normal = [i for i, k in enumerate(self.kinds) if k == NORMAL]
        if any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in normal):
            raise ValueError("a piece of the model crosses words")
        self.dummy = dummy
        self.ids = {self.pieces[i]: i for i in normal}
        self.bytes_ = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        if len(self.bytes_) != 256:
            raise ValueError("the model has no byte fallback")
        self.trie = TrieBpe({self.pieces[i]: -scores[i] for i in normal}, min(PAIRS, remember))
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        #: The text that a piece stands for, but for bytes of longer characters, unknown and control pieces.
        self.plain = {i: p if k == NORMAL else chr(int(p[3:5], 16)) for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL or k == BYTE and int(p[3:5], 16) < 128}
        self.odd = np.array([i not in self.plain for i in range(len(self.pieces))])

    def marked(self, text: str) -> list[str]:
        """The marked words of a text, in order; a word with one mark before it is given without the mark."""
        if self.dummy and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        text = (MARK if self.dummy else "") + text.replace(" ", MARK)
        words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", text)
        return [w[1:] if w[0] == MARK and w[1:2] not in ("", MARK) else MARK * 2 + w for w in words]

    @staticmethod
    def _whole(word: str) -> str:
        """The marked word that ``marked`` gave: two marks more stand before those that aren't one mark and a word."""
        return word[2:] if word[:2] == MARK * 2 else MARK + word

    def _ids_of(self, token: str) -> list[int]:
        found = self.ids.get(token)
        return [found] if found is not None else [self.bytes_[b] for b in token.encode("utf-8", "surrogatepass")]

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text. Words are looked up in blocks, so the trie is shared by many texts; a text longer than a block takes several."""
        most = min(BLOCK, max(1, self.remember // 5))
        block: list[list[str]] = []
        held = 0
        for text in texts:
            words = self.marked(text) if text else []
            if held + len(words) > most:
                yield from self._block(block)
                block, held = [], 0
            if len(words) > most:
                yield np.concatenate([ids for at in range(0, len(words), most) for ids in self._block([words[at : at + most]])])
                continue
            block.append(words)
            held += len(words)
        yield from self._block(block)

    def _block(self, block: list[list[str]]) -> Iterator[np.ndarray]:
        new = set().union(*block).difference(self.known)
        if len(self.known) + len(new) > self.remember and self.known:
            self.known.clear()
            new = set().union(*block)
        whole = {self._whole(word): word for word in new}
        for marked, tokens in self.trie.tokens(sorted(whole)):
            self.known[whole[marked]] = np.array([i for t in tokens for i in self._ids_of(t)], np.int32).tobytes()
        get = self.known.__getitem__
        for words in block:
            yield np.frombuffer(b"".join(map(get, words)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; control ids give nothing, bytes that aren't UTF-8 give U+FFFD."""
        if not self.odd[ids].any():
            return self._unmarked("".join(map(self.plain.__getitem__, ids.tolist())))
        out, run = [], bytearray()
        for i in ids.tolist():
            if self.kinds[i] == BYTE:
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif self.kinds[i] != CONTROL:
                out.append(self.pieces[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return self._unmarked("".join(out))

    def _unmarked(self, text: str) -> str:
        text = text.replace(MARK, " ")
        return text[1:] if self.dummy and text[:1] == " " else text


def _codec(model: bytes, remember: int) -> PieceCodec:
    """One codec a worker process, with the words it has met."""
    codecs, key = worker_cache("sentencepiece"), (hash(model), remember)
    if key not in codecs:
        codecs.clear()
        codecs[key] = PieceCodec(model, remember)
    return codecs[key]


def _model(spark: SparkSession, path: str):
    """The model's bytes (about half a MB, whatever the input) as a broadcast."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


Batches = Iterable[pd.DataFrame]


def encoded(batches: Batches, codec: PieceCodec, text_col: str, ids_col: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500].copy()
            part[ids_col] = list(codec.encode(part[text_col]))
            yield part


def decoded(batches: Batches, codec: PieceCodec, ids_col: str, text_col: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500].copy()
            part[text_col] = [None if ids is None else codec.decode(ids) for ids in part[ids_col]]
            yield part


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text", ids_col: str = "piece_ids", remember: int = REMEMBERED) -> DataFrame:
    """docs with a column of ids (array<int>). An existing column of that name is replaced."""
    sent = _model(docs.sparkSession, model)
    keep = docs.drop(ids_col)
    schema = T.StructType([*keep.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return map_batches(keep, lambda batches: encoded(batches, _codec(sent.value, remember), text_col, ids_col), schema)


def round_trips(docs: DataFrame, model: str = MODEL, remember: int = REMEMBERED) -> DataFrame:
    """docs (with text) and their piece_ids and round_trip (the decoded ids are the text; null: empty); such columns are replaced.

    Encodes and decodes in one Python worker, so decoded texts don't travel.
    """
    sent = _model(docs.sparkSession, model)
    keep = docs.drop("piece_ids", "round_trip")
    schema = T.StructType([*keep.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Batches) -> Iterator[pd.DataFrame]:
        codec = _codec(sent.value, remember)
        for pdf in encoded(batches, codec, "text", "piece_ids"):
            pdf["round_trip"] = [(text or "") == codec.decode(ids) for text, ids in zip(pdf["text"], pdf["piece_ids"], strict=True)]
            yield pdf
            released()

    return map_batches(keep, run, schema)


def decode(docs: DataFrame, model: str = MODEL, ids_col: str = "piece_ids", text_col: str = "decoded", remember: int = REMEMBERED) -> DataFrame:
    """docs with the text of their ids in text_col, which is replaced if it exists; null ids give null."""
    sent = _model(docs.sparkSession, model)
    keep = docs.drop(text_col)
    schema = T.StructType([*keep.schema.fields, T.StructField(text_col, T.StringType())])
    return map_batches(keep, lambda batches: decoded(batches, _codec(sent.value, remember), ids_col, text_col), schema)


def digest(docs: DataFrame, model: str = MODEL, remember: int = REMEMBERED) -> DataFrame:
    """doc_id, n_ids, ids_sha256 (of the ids as little-endian 32-bit integers), round_trip (the decoded text is the text).

    Encodes and decodes in one Python worker, so neither ids nor decoded texts travel.
    """
    sent = _model(docs.sparkSession, model)

    def run(batches: Batches) -> Iterator[pd.DataFrame]:
        codec = _codec(sent.value, remember)
        for pdf in decoded(encoded(batches, codec, "text", "ids"), codec, "ids", "decoded"):
            out = pdf[["doc_id"]].assign(n_ids=[len(x) for x in pdf["ids"]])
            out["ids_sha256"] = [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in pdf["ids"]]
            yield out.assign(round_trip=pdf["text"].fillna("") == pdf["decoded"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_ids long, ids_sha256 string, round_trip boolean")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return digest(documents(spark, sf_dir))


QUERIES = {"op6_sentencepiece": op6_sentencepiece}
ORACLES: dict[str, str] = {}
