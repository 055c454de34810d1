"""Mixture-controlled packing of documents into sequences by deficit round-robin.

Every source is a queue of its documents' tokens. A round gives each queue that still has tokens
its quantum: the share of a sequence that the mixture grants to its source. Quanta are fractions;
what a queue can't be given in whole tokens is its deficit and is carried on. After ``r`` rounds a
queue has given ``floor(r * quantum)`` tokens, or all it has. So the state of every queue at any
round is known without playing the rounds before it, and each task places its own documents.
The rounds' tokens, one queue after the other, are the stream; each full window of it is a
sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import give_back, slices, texts
from tableflow.llm.bitpack import bits_for, pack, partitions, unpack
from tableflow.llm.tokens import encoder
from tableflow.scratch import ship_package, written

SEQUENCE = 1024
#: Quanta are counted in parts of a token.
PARTS = 1 << 10
SLICE_BYTES = 4 << 20


def quanta(totals: np.ndarray, sequence: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Each queue's quantum, in parts of a token, one part at least."""
    weights = totals.astype(float) if weights is None else weights
    share = weights / weights.sum() if weights.sum() > 0 else np.ones(len(totals)) / len(totals)
    return np.maximum(1, np.ceil(share * sequence * PARTS)).astype(np.int64)


def given(rounds: np.ndarray, quantum: int, total: int) -> np.ndarray:
    """The tokens that a queue has given after so many rounds."""
    return np.minimum(rounds * quantum // PARTS, total)


def place(queue: np.ndarray, start: np.ndarray, length: np.ndarray, quantum: np.ndarray,
          total: np.ndarray, sequence: int) -> tuple[np.ndarray, ...]:
    """Where the stream holds runs of queue tokens.

    For each piece: the index of the run, the first token in the run, the length, and the
    position in the stream. Pieces end where a round, a sequence or the run ends; pieces that
    follow each other in the run and within a sequence are one.
    """
    own = quantum[queue]
    first = ((start + 1) * PARTS - 1) // own
    last = np.maximum(((start + length) * PARTS - 1) // own, first)
    # with less than a token a round, most rounds give nothing: a round for each token instead
    slow = own < PARTS
    counts = np.where(slow, length, last - first + 1)
    run = np.repeat(np.arange(len(queue)), counts)
    k = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    rounds = np.where(slow[run], ((start[run] + k + 1) * PARTS - 1) // own[run], first[run] + k)
    queues = queue[run]
    before = np.minimum(rounds * own[run] // PARTS, total[queues])
    after = np.minimum((rounds + 1) * own[run] // PARTS, total[queues])
    begin = np.maximum(before, start[run])
    end = np.minimum(after, start[run] + length[run])
    position = begin - before
    for q in range(len(quantum)):
        gone = given(rounds, quantum[q], total[q])
        position += gone
        earlier = queues > q  # its turn of this round has been
        position[earlier] += given(rounds[earlier] + 1, quantum[q], total[q]) - gone[earlier]
    some = end > begin
    run, begin, position, size = run[some], begin[some], position[some], (end - begin)[some]
    # cut at the ends of sequences
    cuts = (position + size - 1) // sequence - position // sequence + 1
    of = np.repeat(np.arange(len(run)), cuts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    low = np.maximum(position[of], (position[of] // sequence + k) * sequence)
    high = np.minimum(position[of] + size[of], (position[of] // sequence + k + 1) * sequence)
    run, begin, size, position = run[of], begin[of] + low - position[of], high - low, low
    # join what stayed together
    if len(run):
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (position[1:] != position[:-1] + size[:-1]) \
            | (position[1:] % sequence == 0)
        size = np.add.reduceat(size, np.flatnonzero(new))
        run, begin, position = run[new], begin[new], position[new]
    return run, begin - start[run], size, position


def encoded(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str,
            source: str) -> DataFrame:
    """The documents by source and id with their packed ids and their places in their parts."""
    ship_package(docs.sparkSession)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       docs[f"`{text}`"].alias("text"),
                       docs[f"`{source}`"].cast("string").alias("source"))
    rows = rows.repartitionByRange(partitions(docs), "source", "doc_id") \
        .sortWithinPartitions("source", "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        bits = bits_for(max(own.vocabulary, end_id + 1))
        part, held, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            give_back()
            for piece in slices(batch, "text", SLICE_BYTES) if batch.num_rows else ():
                ids, starts, counts = [], [], []
                for one, at in zip(texts(piece.column("text")), piece.column("source").to_pylist()):
                    if at != last:
                        held, last = 0, at
                    found = np.frombuffer(own.ids(one) + end, "<u4")
                    ids.append(pack(found, bits))
                    starts.append(held)
                    counts.append(len(found))
                    held += len(found)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "source": piece.column("source"),
                    "part": pa.array([part] * len(ids), pa.int32()),
                    "part_start": pa.array(starts, pa.int64()),
                    "doc_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                    "bits": pa.array([bits] * len(ids), pa.int32())})

    return written(rows.mapInArrow(encode, "doc_id long, source string, part int, part_start long, "
                                           "doc_tokens long, ids binary, bits int"),
                   "encoded", compression="snappy")  # packed ids hold little to compress


def packed(docs: DataFrame, path: str, end_id: int = 0, mixture: dict[str, float] | None = None,
           sequence: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text",
           source: str = "source", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence.

    ``mixture`` gives sources their weights; sources that it doesn't name have none and are given
    the least quantum. Without it, sources are mixed by their tokens. Only the last sequence can
    be short; it is padded. A null text is empty and has the end id alone; a null source is a
    source; documents of one id are documents of their own. ``with_ids`` adds the pieces' ids.

    The driver and every task hold a row for each source and one for each part of the sorted
    input, which holds few sources; so the number of sources should stay in the thousands.
    """
    rows = encoded(docs, path, end_id, doc_id, text, source)
    parts = rows.groupBy("source", "part").agg(F.sum("doc_tokens").alias("n")) \
        .orderBy("source", "part").collect()
    names = list(dict.fromkeys(part["source"] for part in parts))
    queue_of = {name: i for i, name in enumerate(names)}
    totals = np.zeros(len(names), np.int64)
    offsets = {}
    for part in parts:
        at = queue_of[part["source"]]
        offsets[part["source"], part["part"]] = int(totals[at])
        totals[at] += part["n"]
    weights = None if mixture is None else np.array(
        [float(mixture.get(name, 0.0)) for name in names])
    quantum = quanta(totals, sequence, weights) if names else np.zeros(0, np.int64)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sources = batch.column("source").to_pylist()
                counts = np.asarray(batch.column("doc_tokens"), np.int64)
                queue = np.array([queue_of[name] for name in sources], np.int64)
                before = np.array([offsets[key] for key in
                                   zip(sources, batch.column("part").to_pylist())], np.int64)
                start = before + np.asarray(batch.column("part_start"), np.int64)
                run, begin, size, position = place(queue, start, counts, quantum, totals, sequence)
                ids = [memoryview(unpack(data, n, bits)).cast("B") for data, n, bits in
                       zip(batch.column("ids").to_pylist(), counts.tolist(),
                           batch.column("bits").to_pylist())]
                own = [ids[i][4 * a:4 * (a + n)] for i, a, n in
                       zip(run.tolist(), begin.tolist(), size.tolist())]
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(run)),
                    "start": pa.array(begin), "length": pa.array(size),
                    "ids_crc32": pa.array([zlib.crc32(one) for one in own], pa.int64()),
                    "doc_tokens": pa.array(counts[run]),
                    "sequence_id": pa.array(position // sequence),
                    "offset": pa.array(position % sequence),
                    "source": batch.column("source").take(pa.array(run))}
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(one, "<u4") for one in own],
                                              pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(pieces, "doc_id long, start long, length long, ids_crc32 long, "
                                   "doc_tokens long, sequence_id long, offset long, source string"
                                   + ", ids array<long>" * with_ids)


def sequences(pieces: DataFrame, sequence: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """The padded sequences themselves, from pieces with their ids."""
    rows = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))  # up to a sequence
    ids = F.flatten(F.transform("held", lambda piece: piece["ids"]))
    return rows.select("sequence_id", F.concat(ids, F.array_repeat(
        F.lit(pad_id).cast("long"), sequence - F.size(ids))).alias("ids"),
        F.size(ids).alias("n_tokens"))
