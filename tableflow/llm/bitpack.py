"""Token ids in files of fixed-width bit packing.

A file image holds, all numbers little-endian:

* ``TFIDS1``, the bits of an id (u16), ids in a block (u32), documents (u64), ids (u64),
* the documents' ids (i64 each, after one byte each that tells nulls) and numbers of ids (u64),
* the byte offsets of the blocks (u64 each, one more than there are blocks),
* the blocks: each id in as many bits as the vocabulary needs, first bit highest, filled up with
  zeros to a whole byte.

Spark writes the images as rows of a table, so that its commit protocol covers lost executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.arrow import give_back, slices, texts
from tableflow.llm.tokens import encoder
from tableflow.scratch import ship_package, written

MAGIC = b"TFIDS1"
HEAD = struct.Struct("<6sHIQQ")
BLOCK_IDS = 4096
#: Bytes of text that one image is made from (one document at least).
IMAGE_BYTES = 4 << 20


def bits_for(vocabulary: int) -> int:
    """The least bits that hold every id of the vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids (unsigned 32-bit) in ``bits`` bits each, highest bit first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits == 16:  # the same layout
        return ids.astype(">u2").tobytes()
    every = np.unpackbits(ids.astype(">u4").view(np.uint8)).reshape(-1, 32)
    return np.packbits(every[:, 32 - bits:]).tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed data, as unsigned 32-bit integers."""
    if bits == 16:
        return np.frombuffer(data, ">u2", count).astype("<u4")
    own = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(-1, bits)
    every = np.zeros((count, 32), np.uint8)
    every[:, 32 - bits:] = own
    return np.packbits(every).view(">u4").astype("<u4")


def image(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, bits: int,
          block_ids: int = BLOCK_IDS) -> bytes:
    """One file image of whole documents, whose ids follow each other."""
    blocks = [pack(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0] + [len(block) for block in blocks], dtype="<u8")
    return b"".join([HEAD.pack(MAGIC, bits, block_ids, len(doc_ids), len(ids)),
                     bytes(doc_id is None for doc_id in doc_ids),
                     np.array([doc_id or 0 for doc_id in doc_ids], "<i8").tobytes(),
                     np.asarray(counts, "<u8").tobytes(), offsets.tobytes(), *blocks])


class Image:
    """Reads a file image: all documents at once, or any run of ids by the block offsets."""

    def __init__(self, data: bytes):
        self.data = data
        magic, self.bits, self.block_ids, docs, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        at = HEAD.size
        nulls = data[at:at + docs]
        at += docs
        numbers = np.frombuffer(data, "<i8", docs, at).tolist()
        self.doc_ids = [None if null else number for null, number in zip(nulls, numbers)]
        self.counts = np.frombuffer(data, "<u8", docs, at + 8 * docs).astype(np.int64)
        at += 16 * docs
        blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.first = at + 8 * (blocks + 1)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on; only the blocks that hold them are unpacked."""
        count = max(0, min(count, self.n_ids - start))
        if not count:
            return np.zeros(0, "<u4")
        found, first = [], start // self.block_ids
        for block in range(first, (start + count - 1) // self.block_ids + 1):
            held = min(self.block_ids, self.n_ids - block * self.block_ids)
            data = self.data[self.first + self.offsets[block]:self.first + self.offsets[block + 1]]
            found.append(unpack(data, held, self.bits))
        skipped = start - first * self.block_ids
        return np.concatenate(found)[skipped:skipped + count]


def partitions(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_images(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id",
                 text: str = "text", image_bytes: int = IMAGE_BYTES) -> DataFrame:
    """Encode and pack all documents in ascending ``doc_id`` order; the table of images.

    Columns: ``part`` and ``piece`` (the images' order), ``part_start`` (ids before the image in
    its part), ``n_ids`` and ``image``. A null text is empty, so only the end id stands for it; a
    null id comes first; documents of one id follow in the order of their texts.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       docs[f"`{text}`"].alias("text"))
    rows = rows.repartitionByRange(partitions(docs), "doc_id") \
        .sortWithinPartitions("doc_id", "text")

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        bits = bits_for(max(encode.vocabulary, end_id + 1))
        part, piece, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            give_back()
            for own in slices(batch, "text", image_bytes) if batch.num_rows else ():
                found = [encode.ids(one) + end for one in texts(own.column("text"))]
                ids = np.frombuffer(b"".join(found), "<u4")
                data = image(own.column("doc_id").to_pylist(),
                             np.array([len(one) // 4 for one in found]), ids, bits)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "piece": pa.array([piece], pa.int32()),
                    "part_start": [start], "n_ids": [len(ids)],
                    "image": pa.array([data], pa.binary())})
                piece, start = piece + 1, start + len(ids)

    return written(rows.mapInArrow(
        images, "part int, piece int, part_start long, n_ids long, image binary"), "token_ids")


def read_images(images: DataFrame) -> DataFrame:
    """Per document of the images: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it. The parts' totals (a row for each
    partition that wrote) are summed up in order and sent to all tasks.
    """
    totals = images.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("before"))
    rows = images.join(F.broadcast(before), "part") \
        .select((F.col("before") + F.col("part_start")).alias("start"), "image")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column("start").to_pylist(), batch.column("image")):
                held = Image(data.as_py())
                ids = memoryview(held.ids(0, held.n_ids)).cast("B")
                ends = np.cumsum(held.counts)
                starts = ends - held.counts
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(held.doc_ids, pa.int64()),
                    "start": pa.array(starts + first, pa.int64()),
                    "n_tokens": pa.array(held.counts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[4 * a:4 * b]) for a, b in
                                           zip(starts.tolist(), ends.tolist())], pa.int64())})

    return rows.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
