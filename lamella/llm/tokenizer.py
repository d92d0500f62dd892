"""Byte-level BPE by a sentencepiece model that is serialised from a public vocabulary.

The vocabulary file (base64 token and rank per line) becomes a BPE model whose pieces
are the tokens, byte by byte mapped to printable characters, with the negative rank as
score and without any normalisation. Texts are cut into pre-tokens by the vocabulary's
pattern, and each distinct pre-token is encoded once.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public tokenizers; the session setting of this name overrides the default.
FOLDER_SETTING = "spark.lamella.tokenizers"
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits text before merging, \s spelled out as Unicode's White_Space.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Pre-tokens whose ids a worker keeps; longer ones than CACHED_CHARS are not kept.
CACHE = 400_000
CACHED_CHARS = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is a visible Latin-1 character, else the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in visible}
    for b in range(256):
        if b not in out:
            out[b] = chr(0x100 + len(out) - len(visible))
    return [out[b] for b in range(256)]


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, which must be 0, 1, 2, ..."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks in {path} are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _block(number: int, content: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(content)) + content


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: Sequence[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece model; a piece's id is its token's rank, the unknown piece comes last."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2  # SentencePiece.Type and TrainerSpec.ModelType
    piece = lambda text, score, kind: _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))
    pieces = [piece("".join(chars[b] for b in t), -float(i), normal) for i, t in enumerate(tokens)]
    pieces.append(piece("<unk>", 0.0, unknown))
    n = len(tokens)
    absent = (1 << 64) - 1  # -1 as a varint
    trainer = _number(3, bpe) + _number(4, n + 1) + _number(40, n) + _number(41, absent) + _number(42, absent) + _number(43, absent)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class Encoder:
    """Encodes and decodes with one serialised model; texts are whole, of any length."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chars = byte_characters()
        self.bytes = {ord(c): b for b, c in enumerate(self.chars)}
        self.table = {b: c for b, c in enumerate(self.chars)}
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}

    def _mapped(self, pre_token: str) -> str:
        return pre_token.encode("utf-8", "replace").decode("latin-1").translate(self.table)

    def encode(self, texts: Sequence[str | None]) -> list[list[int]]:
        """Token ids of each text; none for an empty and a null text."""
        cut = [self.split(t) if t else [] for t in texts]
        new = list({w for words in cut for w in words if w not in self.known})
        found = dict(zip(new, self.sp.encode([self._mapped(w) for w in new], out_type=int))) if new else {}
        known = self.known
        out = []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += known[w] if w in known else found[w]
            out.append(ids)
        if len(known) + len(found) > CACHE:
            known.clear()
        known.update((w, i) for w, i in found.items() if len(w) <= CACHED_CHARS)
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """Text of the ids, by the pieces and the inverse byte mapping."""
        text = "".join(self.sp.id_to_piece(list(ids))) if len(ids) else ""
        return bytes(self.bytes[ord(c)] for c in text).decode("utf-8", "replace")


_ENCODERS: dict[bytes, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    """The worker's encoder for a model, built once per process."""
    key = model[:64] + len(model).to_bytes(8, "little")
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def model_of(spark: SparkSession, vocabulary: str = VOCABULARY) -> bytes:
    """Serialised model of a vocabulary in the session's tokenizer folder."""
    return serialise_model(read_vocabulary(os.path.join(spark.conf.get(FOLDER_SETTING, FOLDER), vocabulary)))


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_SIZES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
#: Characters that are encoded at once within an Arrow batch.
CHUNK_CHARS = 4_000_000


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """Rows of a batch in runs of bounded text: (first row, texts)."""
    text = batch["text"]
    sizes = np.nan_to_num(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    part = np.cumsum(sizes) // CHUNK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, z in zip(cuts, cuts[1:]):
        yield a, text.slice(a, z - a).to_pylist()


def encode_corpus(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: bytes | None = None) -> DataFrame:
    """(doc_id, ids) of every row: its token ids without special tokens.

    An empty and a null text have an empty list; repeated rows give repeated rows;
    a null id stays null. Strings that spell a special token are ordinary text.
    Columns besides ``doc_id`` and ``text`` are not read. One pass without a
    shuffle; the model, of a fixed size, goes to the tasks with the function.
    """
    model = model or model_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(model)
        for b in batches:
            for first, texts in _chunks(b):
                ids = enc.encode(texts)
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                flat = np.fromiter((x for i in ids for x in i), np.int32, int(offsets[-1]))
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(first, len(ids)), lists], schema=_IDS)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row, as :func:`encode_corpus` without moving the ids out of the workers."""
    model = model or model_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(model)
        for b in batches:
            for first, texts in _chunks(b):
                sizes = pa.array([len(i) for i in enc.encode(texts)], pa.int64())
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(first, len(sizes)), sizes], schema=_SIZES)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def decode_corpus(encoded: DataFrame, *, doc_id: str = "doc_id", ids: str = "ids", model: bytes | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null, ids cut inside a character a replacement character."""
    model = model or model_of(encoded.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(model)
        for b in batches:
            texts = [None if i is None else enc.decode(i) for i in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], schema=schema)

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
