"""Byte-level BPE by a sentencepiece model that is written out from the vocabulary.

The vocabulary's byte strings become pieces of visible characters, one character for each byte,
scored by their negative rank: sentencepiece then merges, like byte-level BPE, the neighbours of
the lowest rank first. The model normalises nothing and is given one pre-token at a time.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import appended, texts
from tableflow.llm.tokens import ByParts, byte_characters, packed_ids, visible
from tableflow.scratch import ship_package

#: Field numbers and values of the sentencepiece model format (fixed).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, UNUSED = 1, 2, 5
BPE = 2


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 byte string and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _varint(number: int) -> bytes:
    number &= (1 << 64) - 1
    found = bytearray()
    while number > 0x7F:
        found.append(number & 0x7F | 0x80)
        number >>= 7
    return bytes(found + bytes([number]))


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def serialised(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece BPE model whose ids are the ranks."""
    shown = byte_characters()
    by_rank = {rank: piece for piece, rank in ranks.items()}
    size = max(by_rank, default=-1) + 1
    parts = []
    for rank in range(size):
        piece = by_rank.get(rank)
        text = f"<unused {rank}>" if piece is None else "".join(shown[byte] for byte in piece)
        parts.append(_field(PIECES, _field(1, text.encode()) + _field(2, float(-rank))
                            + _field(3, UNUSED if piece is None else NORMAL)))
    parts.append(_field(PIECES, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN)))
    trainer = _field(3, BPE) + _field(4, size + 1) + _field(40, size) + b"".join(
        _field(special, -1) for special in (41, 42, 43))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*parts, _field(TRAINER, trainer), _field(NORMALIZER, identity)])


class Codec:
    """Encodes and decodes whole texts; one for each worker and rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(ranks))
        self.find = regex.compile(pattern).findall
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes[rank] = piece
        self.decimals = [str(rank) for rank in range(len(self.bytes))]
        self.whole = ranks
        self.ids_bytes = ByParts(self.part_ids).ids

    def part_ids(self, part: str) -> bytes:
        found = []
        for token in self.find(part):
            rank = self.whole.get(token.encode())
            if rank is None:
                found += self.model.encode(visible(token))
            else:
                found.append(rank)
        return packed_ids(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.ids_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The documents with ``ids`` (array of int); a null text has none."""
    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        own = codec(path, pattern)
        return [pa.array([own.encode(one) for one in texts(batch.column("text"))],
                         pa.list_(pa.int32()))]

    return _with(docs, text, "ids array<int>", ids)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The documents with the number and digest of their ids, and the digest of what they decode to.

    A null text is empty: it has no ids and decodes to nothing. Every row stands for itself.
    """
    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        own = codec(path, pattern)
        counts, ids_sha, text_sha = [], [], []
        for one in texts(batch.column("text")):
            ids = own.encode(one)
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(
                ",".join(map(own.decimals.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                pa.array(text_sha, pa.string())]

    return _with(docs, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", found)


def _with(docs: DataFrame, text: str, fields: str, compute) -> DataFrame:
    """``row`` (all columns of the documents) and the computed fields."""
    ship_package(docs.sparkSession)
    row = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    return appended(docs.select(row, docs[f"`{text}`"].alias("text")), fields, compute,
                    drop=("text",))
