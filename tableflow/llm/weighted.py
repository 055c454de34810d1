"""Document fingerprints by consistent weighted sampling.

A text's terms are its words and its pairs of neighbouring words, weighted by how often they
occur. Every sample of a fingerprint draws one term: a term of weight w competes with the least
value of a gamma process up to w, which depends on the term and the sample only. Two texts draw
the same term at the same level with a probability that equals their generalised Jaccard
similarity, the sum of the lesser weights over the sum of the greater.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import appended, slices, texts
from tableflow.llm.bitpack import partitions
from tableflow.llm.windows import as_words, blocks_of, mixed, word_hashes
from tableflow.scratch import ship_package, written

SAMPLES = 64
#: Rows of the tables that a term's draws are put together from: one row of each, by its hash.
ROWS = 1 << 14
SEED = 8
SLICE_BYTES = 1 << 20
#: Terms that compete at once; the samples' winners go on to the next ones.
CHUNK = 1 << 13


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, ...]:
    """Of two tables by row and sample: r (gamma of shape 2), beta and r (1 - beta) of the one,
    ln c (gamma of shape 2) of the other.

    Terms have a row of each by different bits of their hashes. Those that share one row differ in
    the other, so all terms compete on their own however many there are.
    """
    rng = np.random.default_rng(SEED)
    r = rng.gamma(2, size=(ROWS, SAMPLES)).astype(np.float32)
    beta = rng.random((ROWS, SAMPLES), np.float32)
    c = np.log(rng.gamma(2, size=(ROWS, SAMPLES))).astype(np.float32)
    return r, beta, r * (1 - beta), c


def signature(terms: np.ndarray) -> np.ndarray:
    """A byte for each sample of a text with these terms (64-bit hashes), repeats included."""
    if not len(terms):
        return np.zeros(SAMPLES, np.uint8)
    terms, weights = np.unique(terms, return_counts=True)
    r, beta, single, c = draws()
    samples = np.arange(SAMPLES)
    least = np.full(SAMPLES, np.inf, np.float32)
    winner, reached = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.uint64)
    for low in range(0, len(terms), CHUNK):
        own, weight = terms[low:low + CHUNK], weights[low:low + CHUNK]
        one = (own & np.uint64(ROWS - 1)).astype(np.int64)
        other = (own >> np.uint64(32) & np.uint64(ROWS - 1)).astype(np.int64)
        value = c[other] - single[one]
        more = np.flatnonzero(weight > 1)
        level = np.zeros((len(own), SAMPLES), np.float32) if len(more) else None
        if len(more):
            row = one[more]
            level[more] = np.floor(np.log(weight[more])[:, None].astype(np.float32) / r[row]
                                   + beta[row])
            value[more] = c[other[more]] - r[row] * (level[more] - beta[row] + 1)
        drawn = value.argmin(axis=0)
        better = value[drawn, samples] < least
        at = drawn[better]
        least[better], winner[better] = value[at, samples[better]], own[at]
        reached[better] = 0 if level is None else level[at, samples[better]].astype(np.uint64)
    return (mixed(winner ^ mixed(reached + np.uint64(1))) >> np.uint64(56)).astype(np.uint8)


def signatures(column: list[str]) -> np.ndarray:
    """The signatures of texts, one row each."""
    split = as_words(pa.array(column, pa.large_string()))
    first, last = split.words
    words = word_hashes(split.data, first, last)
    pairs = mixed(blocks_of(words, 2)[0]) if len(words) > 1 else words[:0]
    found = np.zeros((len(column), SAMPLES), np.uint8)
    for i, (a, b) in enumerate(zip(split.documents[:-1], split.documents[1:])):
        found[i] = signature(np.concatenate([words[a:b], pairs[a:max(a, b - 1)]]))
    return found


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The estimated similarity: equal samples, less those that are equal by chance."""
    equal = (one == other).mean(axis=1)
    return np.maximum(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def edited(text: str, following: str) -> str:
    """The text whose last quarter is replaced by as much of the next one's beginning."""
    count = len(text) // 4
    return text[:len(text) - count] + following[:count]


def _compared(doc_ids: list, own: list[str], following: list[str]) -> dict[str, pa.Array]:
    changed = [edited(a, b) for a, b in zip(own, following)]
    one, other, after = signatures(own), signatures(changed), signatures(following)
    return {
        "doc_id": pa.array(doc_ids, pa.int64()),
        "n_chars": pa.array([len(text) for text in own], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed],
                                  pa.string()),
        "fingerprint": pa.array([row.tobytes().hex() for row in one], pa.string()),
        "edited_fingerprint": pa.array([row.tobytes().hex() for row in other], pa.string()),
        "near_edited": pa.array(likeness(one, other)),
        "near_next": pa.array(likeness(one, after))}


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def fingerprinted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns) and ``fingerprint`` of every document; a null text has no terms."""
    ship_package(docs.sparkSession)

    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        own = signatures(texts(batch.column("text")))
        return [pa.array([row.tobytes().hex() for row in own], pa.string())]

    row = F.struct(F.lit(True).alias("__row"), *[docs[f"`{name}`"] for name in docs.columns])
    return appended(docs.select(row.alias("row"), docs[f"`{text}`"].alias("text")),
                    "fingerprint string", found, drop=("text",))


def compared_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, its edited text's, and both likenesses (see ``FIELDS``).

    The next document is the next by ascending id, documents of one id by their texts; a null id
    comes first, and after the last comes the first. A null text is empty; texts without a word
    are alike. The last document of each sorted part meets the first of the next part afterwards:
    two texts for each part are kept for that.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"))
    rows = rows.repartitionByRange(partitions(docs), "doc_id") \
        .sortWithinPartitions("doc_id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES) if batch.num_rows else ():
                ids, own = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
                if last is None:
                    yield _edge(part, "first", ids[0], own[0])
                else:
                    ids.insert(0, last[0])
                    own.insert(0, last[1])
                last = ids[-1], own[-1]
                found = _compared(ids[:-1], own[:-1], own[1:])
                count = len(ids) - 1
                if count:
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part] * count, pa.int32()),
                        "edge": pa.nulls(count, pa.string()),
                        "text": pa.nulls(count, pa.string()), **found})
        if last is not None:
            yield _edge(part, "last", *last)

    found = written(rows.mapInArrow(
        compare, f"part int, edge string, text string, {FIELDS}"), "fingerprints")
    edges = found.where("edge is not null")
    parts = [row["part"] for row in edges.where("edge = 'last'").select("part")
             .orderBy("part").collect()]  # a number for each part
    following = dict(zip(parts, parts[1:] + parts[:1]))
    spark = docs.sparkSession
    after = spark.createDataFrame(list(following.items()), "part int, next int")
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("next"),
                                                  F.col("text").alias("following"))
    pairs = edges.where("edge = 'last'").select("part", "doc_id", "text") \
        .join(after, "part").join(firsts, "next").select("doc_id", "text", "following")

    def compare_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(_compared(*[batch.column(name).to_pylist() for name in
                                                         ("doc_id", "text", "following")]))

    return found.where("edge is null").drop("part", "edge", "text").unionByName(
        pairs.mapInArrow(compare_edges, FIELDS))


def _edge(part: int, edge: str, doc_id: int | None, text: str) -> pa.RecordBatch:
    strings = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int32()), "edge": pa.array([edge]),
        "text": pa.array([text], pa.string()), "doc_id": pa.array([doc_id], pa.int64()),
        "n_chars": pa.nulls(1, pa.int64()),
        **{name: pa.nulls(1, pa.string()) for name in strings},
        "near_edited": pa.nulls(1, pa.float64()), "near_next": pa.nulls(1, pa.float64())})
