"""Phrase mining by Toivonen's sampling: a sample proposes, full passes count and close.

Frequent phrases are contiguous words within a piece of text, counted by language. A sample of the
documents is counted first; the phrases that are frequent in it, at a lowered count, are proposed.
The full pass counts every word, the proposed phrases and their *negative border*: the phrases that
are not proposed but whose two parts without the last and without the first word are. What is
frequent is either counted, or it holds a counted phrase of the border that is frequent: such a
failure is added to the proposals, and a further pass expands them until they are closed: it counts
what becomes border by a failure, takes all of that for proposed, counts what becomes border by
that, and so on up to the longest phrases. Counts are exact; the sample only decides on the work.

The border is never listed, it would be all pairs of words: each place in a text tells by its
own two parts whether its phrase is counted. The proposals are sent to the tasks as a filter of a
fixed number of bits, which may take a phrase for proposed that isn't: then more is counted, and
nothing is missed. Tasks add up the phrases of a slice of text and send them to the shards of
their hashes in compressed blocks; no task or driver holds all of them.

A phrase is known by a 64-bit hash of the hash of its words but the last and that of its last
word, so counted phrases can be put together to words again from one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.arrow import give_back, slices, text_bytes
from tableflow.llm.windows import U, gathered, mixed, squeezed, unsqueezed, word_hashes
from tableflow.scratch import ship_package, written

LONGEST = 5
MIN_COUNT = 100
FIRST = 2000
#: A longer phrase with at least this percentage of its part's count replaces the part.
REPLACES = 100
#: One document in so many is in the sample.
SAMPLE = 10
#: Bits of the filter, two of them for a phrase, and the blocks that it is put together from.
FILTER_BITS = 27
FILTER_BLOCKS = 64
#: Text that a task looks at at once (a document at least), and words of it.
SLICE_BYTES = 2 << 20
CHUNK = 1 << 18
#: Text whose phrases are counted in a shard, about, and parts of them that are counted at once.
SHARD_BYTES = 5 << 20
CLASSES = 4

#: White space between words, and what ends a piece (fixed by the contract).
BLANK, BREAK = b" \t", b".,;:!?\n\v\f\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANK)] = 1
_KIND[list(BREAK)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LINK = U(0x9E6C63D0876A9A35)

FIELDS = "k int, lang string, word string, prefix long, last long, n long, id long"
BLOCKS = "shard long, words boolean, block binary"


def linked(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase by those of its words but the last, and of the last."""
    return mixed(prefix * _LINK + last)


class Words:
    """The words of some texts: their bytes, their pieces, and their hashes by language."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = text_bytes(pc.binary_join_element_wise(
            texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()),
            pa.scalar("\n", pa.large_string())))  # a text ends its last piece
        self.data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        change = np.diff(inside.astype(np.int8), prepend=0)  # data ends with a break, if any
        self.first, self.end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.first)
        coded = langs.fill_null("und").dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        document = np.searchsorted(offsets, self.first, "right") - 1
        self.lang = np.asarray(coded.indices).astype(np.int64)[document]
        salts = np.array([xxhash.xxh64_intdigest(lang.encode()) for lang in self.langs], np.uint64)
        self.hashes = mixed(word_hashes(self.data, self.first, self.end) ^ salts[self.lang])

    def __len__(self) -> int:
        return len(self.first)


class Proposed:
    """A filter of the proposed phrases: never wrong about one that is in it."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = U((1 << FILTER_BITS) - 1)
        return (hashes >> U(64 - FILTER_BITS)).astype(np.int64), (hashes & size).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        one, other = self.places(hashes)
        return self._set(one) & self._set(other)

    def _set(self, places: np.ndarray) -> np.ndarray:
        return (self.bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def counted(words: Words, now: Proposed | None, before: Proposed | None
            ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each chunk and length: the places of the phrases to count, and the hashes there of all
    words but the last, and of the phrase.

    ``now`` is the filter of proposals (None: all phrases are counted), ``before`` that of the
    passes so far, whose phrases are left out. What is counted the first time is taken for
    proposed within the pass, so one pass also counts what could become border by its failures.
    """
    for low in range(0, len(words), CHUNK):
        high = min(len(words), low + CHUNK)
        ahead = min(len(words), high + LONGEST - 1)
        single, piece = words.hashes[low:ahead], words.piece[low:ahead]
        own = high - low
        if before is None:
            yield 1, np.arange(low, high), np.zeros(own, np.uint64), single[:own]
        hashes = single.copy()
        member = np.ones(len(single), bool) if now is None else now.holds(single)
        earlier = None if before is None else before.holds(single)
        for k in range(2, LONGEST + 1):
            at = np.flatnonzero(member[:-1] & member[1:]) if len(member) > 1 else \
                np.zeros(0, np.int64)
            at = at[at + k <= len(single)]
            at = at[piece[at + k - 1] == piece[at]]
            prefix = hashes[at]
            hashes[at] = whole = linked(prefix, single[at + k - 1])
            new = np.ones(len(at), bool)
            if earlier is not None:
                new = ~(earlier[at] & earlier[at + 1])
                earlier[:] = False
                earlier[at] = before.holds(whole)
            member[:] = False
            member[at] = True if now is None else now.holds(whole)
            if before is not None:
                member[at[new]] = True
            chosen = new & (at < own)
            yield k, at[chosen] + low, prefix[chosen], whole[chosen]


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A sorting of the hashes, where each new one starts in it, and how often each occurs."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) \
        if len(order) else np.zeros(0, np.int64)
    return order, starts, np.diff(np.append(starts, len(order)))


def _shards(hashes: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """The shards of sorted hashes: each with its first and end."""
    shard = ((hashes >> U(32)) * U(shards)) >> U(32)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    ends = np.append(cuts, len(shard))
    return [(int(shard[start]), int(start), int(end))
            for start, end in zip(np.append(0, cuts), ends) if end > start]


def _blocks_of(words: Words, now: Proposed | None, before: Proposed | None, shards: int
               ) -> Iterator[tuple[int, bool, bytes]]:
    """What the shards get of some texts."""
    single = [part for part in counted(words, now, before)]
    longer = [part for part in single if part[0] > 1]
    single = [part for part in single if part[0] == 1]
    if single:
        places, hashes = [np.concatenate(column) for column in list(zip(*single))[1::2]]
        order, starts, n = _grouped(hashes)
        places, hashes = places[order[starts]], hashes[order[starts]]
        for shard, start, end in _shards(hashes, shards):
            at = places[start:end]
            first, last = words.first[at], words.end[at]
            names = "\n".join(words.langs).encode()
            yield shard, True, squeezed(
                hashes[start:end], n[start:end].astype(np.uint32),
                words.lang[at].astype(np.uint16), (last - first).astype(np.uint32),
                gathered(words.data, first, last), np.frombuffer(names, np.uint8),
                np.array([len(lang.encode()) for lang in words.langs], np.uint32))
    if longer:
        sizes = np.concatenate([np.full(len(part[1]), part[0], np.uint8) for part in longer])
        prefix, hashes = [np.concatenate(column) for column in list(zip(*longer))[2:]]
        places = np.concatenate([part[1] for part in longer])
        order, starts, n = _grouped(hashes)
        example = order[starts]
        for shard, start, end in _shards(hashes[example], shards):
            own = example[start:end]
            inner = np.argsort(prefix[own])  # like ones side by side
            own = own[inner]
            last = words.hashes[places[own] + sizes[own] - 1]
            yield shard, False, squeezed(np.diff(prefix[own], prepend=U(0)), last,
                                         n[start:end][inner].astype(np.uint32), sizes[own])


def _summed(table: pa.Table, least: int) -> pa.Table:
    """Of a shard's blocks the phrases that occur often enough, and the languages' words."""
    give_back()
    if table.column("words")[0].as_py():
        return _summed_words(table, least)
    parts = []
    for block in table.column("block"):
        steps, last, n, k = unsqueezed(block.as_py())
        prefix = np.cumsum(steps, dtype=np.uint64)
        parts.append((prefix, last, n, k, linked(prefix, last)))
    found = []
    for number in range(CLASSES):  # one after the other, which takes less memory
        own = [[column[at] for column in part] for part in parts
               if len(at := np.flatnonzero(part[4] & U(CLASSES - 1) == number))]
        if not own:
            continue
        prefix, last, n, k, hashes = [np.concatenate(column) for column in zip(*own)]
        order, starts, _ = _grouped(hashes)
        total = np.add.reduceat(n[order].astype(np.int64), starts)
        often = np.flatnonzero(total >= least)
        at = order[starts[often]]
        none = pa.nulls(len(at), pa.string())
        found.append(_table(k[at], none, none, prefix[at], last[at], total[often], hashes[at]))
    return pa.concat_tables(found)


def _summed_words(table: pa.Table, least: int) -> pa.Table:
    names, parts = {}, []
    texts = []
    for block in table.column("block"):
        hashes, n, lang, sizes, data, known, lengths = unsqueezed(block.as_py())
        ends = np.cumsum(lengths.astype(np.int64) + 1)
        own = [known[end - 1 - length:end - 1].tobytes().decode()
               for end, length in zip(ends.tolist(), lengths.tolist())]
        number = np.array([names.setdefault(name, len(names)) for name in own], np.int64)
        parts.append((hashes, n.astype(np.int64), number[lang], sizes.astype(np.int64)))
        texts.append(data)
    hashes, n, lang, sizes = [np.concatenate(column) for column in zip(*parts)]
    data = np.concatenate(texts)
    ends = np.cumsum(sizes)
    order, starts, _ = _grouped(hashes)
    total = np.add.reduceat(n[order], starts)
    often = np.flatnonzero(total >= least)
    at = order[starts[often]]
    offsets = np.concatenate([[0], np.cumsum(sizes[at])])
    word = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(offsets), pa.py_buffer(gathered(data, ends[at] - sizes[at], ends[at])))
    listed = np.array(list(names), object)
    found = _table(np.ones(len(at)), pa.array(listed[lang[at]], pa.string()),
                   word.cast(pa.string()), np.zeros(len(at), np.uint64), hashes[at], total[often],
                   hashes[at])
    sums = np.bincount(lang, n, minlength=len(listed)).astype(np.int64)  # exact below 2^53
    zeros = np.zeros(len(listed), np.uint64)
    return pa.concat_tables([found, _table(
        zeros, pa.array(listed, pa.string()), pa.nulls(len(listed), pa.string()), zeros, zeros, sums,
        zeros)])


def _table(k, lang: pa.Array, word: pa.Array, prefix, last, n, whole) -> pa.Table:
    return pa.table({"k": pa.array(k.astype(np.int32)), "lang": lang, "word": word,
                     "prefix": _longs(prefix), "last": _longs(last),
                     "n": pa.array(n.astype(np.int64)), "id": _longs(whole)})


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _counts(docs: DataFrame, shards: int, least: int, now: Broadcast | None = None,
            before: Broadcast | None = None) -> DataFrame:
    """The phrases that are proposed or border and occur often enough, beyond those before.

    Rows of ``k`` zero are parts of a language's number of words.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [None if one is None else Proposed(_bits(one.value)) for one in (now, before)]
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES) if batch.num_rows else ():
                words = Words(piece.column("text"), piece.column("lang"))
                found = list(zip(*_blocks_of(words, *filters, shards)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[0], pa.int64()), pa.array(found[1], pa.bool_()),
                         pa.array(found[2], pa.binary())], ["shard", "words", "block"])
            give_back()

    return docs.mapInArrow(send, BLOCKS).groupBy("shard", "words") \
        .applyInArrow(lambda table: _summed(table, least), FIELDS)


def _failures(found: DataFrame, now: Broadcast) -> DataFrame:
    """The frequent phrases, short enough to be part of others, that were not proposed."""
    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        proposed = Proposed(_bits(now.value))
        for batch in batches:
            ids = np.asarray(batch.column(0)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([_longs(ids[~proposed.holds(ids)])], ["id"])

    return found.where(F.col("k").between(1, LONGEST - 1)).select("id") \
        .mapInArrow(missed, "id long")


def _filter(ids: DataFrame, and_those: bytes | None) -> bytes:
    """The filter (compressed) with the phrases of ``ids``, on the driver: of fixed size."""
    size = (1 << FILTER_BITS) // 8
    part = size // FILTER_BLOCKS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.uint8)
        for batch in batches:
            for places in Proposed.places(np.asarray(batch.column(0)).view(np.uint64)):
                np.bitwise_or.at(found, places >> 3, (1 << (places & 7)).astype(np.uint8))
        some = [block for block in range(FILTER_BLOCKS)
                if found[block * part:(block + 1) * part].any()]
        yield _blocks(some, [found[block * part:(block + 1) * part] for block in some])

    def joined(table: pa.Table) -> pa.Table:
        found = np.zeros(part, np.uint8)
        for block in table.column("bits"):
            found |= _bits(block.as_py())
        return pa.Table.from_batches([_blocks([table.column("block")[0].as_py()], [found])])

    schema = "block int, bits binary"
    found = np.zeros(size, np.uint8) if and_those is None else _bits(and_those).copy()
    for row in ids.mapInArrow(bits, schema).groupBy("block").applyInArrow(joined, schema).collect():
        found[row["block"] * part:(row["block"] + 1) * part] |= _bits(row["bits"])
    return _squeezed(found)


def _squeezed(bits: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(bits.tobytes())


def _bits(block: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)


def _blocks(numbers: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array(numbers, pa.int32()),
                                       "bits": pa.array(map(_squeezed, parts), pa.binary())})


def lowered(min_count: int, sample: int) -> int:
    """The count in the sample from which on a phrase is proposed.

    Two standard deviations below what is expected of a phrase that is just frequent.
    """
    expected = min_count / sample
    return max(1, math.floor(expected - 2 * math.sqrt(expected)))


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, sample: int = SAMPLE,
             text: str = "text", lang: str = "lang") -> DataFrame:
    """All words and phrases with at least ``min_count`` occurrences in their language.

    Rows have ``k`` (words), ``id`` (hash), ``prefix`` and ``last`` (hashes of the parts), ``n``,
    and ``lang`` and ``word`` for single words. Rows of ``k`` zero have parts of a language's
    number of words. A null text has no words; a null language is ``und``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(docs[f"`{text}`"].cast("string").alias("text"),
                       docs[f"`{lang}`"].cast("string").alias("lang"),
                       F.xxhash64(*[docs[f"`{name}`"] for name in docs.columns
                                    if docs.schema[name].dataType.typeName() != "map"]).alias("at"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    some = rows.where(F.pmod("at", F.lit(sample)) == 0).select("text", "lang")
    rows = rows.select("text", "lang")
    likely = _counts(some, shards, lowered(min_count, sample)).where("k > 0")
    proposed = _filter(likely.select("id"), None)
    before = spark.sparkContext.broadcast(proposed)
    found = written(_counts(rows, shards, min_count, before), "frequent")
    failed = written(_failures(found, before), "failures")
    if not failed.limit(1).count():
        return found
    # What this pass finds can't be the start of more: it has counted what that would bring, too.
    now = spark.sparkContext.broadcast(_filter(failed, proposed))
    return found.unionByName(written(_counts(rows, shards, min_count, now, before), "frequent_2"))


def spelled(found: DataFrame) -> list[DataFrame]:
    """For each length the phrases with their language, text and words' hashes."""
    single = found.where("k = 1")
    levels = [written(single.select("id", "n", "lang", F.col("word").alias("phrase"),
                                    F.array("id").alias("hashes")), "words")]
    ends = single.select(F.col("id").alias("last"), F.col("word").alias("last_word"))
    for k in range(2, LONGEST + 1):
        shorter = levels[-1].select(F.col("id").alias("prefix"), "lang", "phrase", "hashes")
        rows = found.where(F.col("k") == k).select("id", "prefix", "last", "n") \
            .join(shorter, "prefix").join(ends, "last")
        levels.append(written(rows.select(
            "id", "n", "lang", F.concat_ws(" ", "phrase", "last_word").alias("phrase"),
            F.concat("hashes", F.array("last")).alias("hashes")), f"phrases_{k}"))
    return levels


def _parts(phrases: DataFrame) -> DataFrame:
    """A row for each cut of a phrase, with the hashes of the parts before and after it."""
    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = np.asarray(batch.column("hashes").flatten()).view(np.uint64) \
                .reshape(batch.num_rows, -1)
            for cut in range(1, words.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(np.full(len(words), cut, np.int32)),
                     _longs(_chained(words[:, :cut])), _longs(_chained(words[:, cut:]))],
                    ["id", "cut", "first", "rest"])

    return phrases.select("id", "hashes").mapInArrow(cuts, "id long, cut int, first long, rest long")


def _chained(words: np.ndarray) -> np.ndarray:
    found = words[:, 0]
    for at in range(1, words.shape[1]):
        found = linked(found, words[:, at])
    return np.ascontiguousarray(found)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, first: int = FIRST,
                 sample: int = SAMPLE, text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's ``first`` phrases of 2 to 5 words by how much more they occur than by chance.

    ``a`` is the phrase's count, ``n`` the language's words. A cut into two parts with counts l and
    r has the score floor(1000 a n / (l r)); the least, of the cut nearest the start, counts.
    Phrases that are never found outside a longer one are left out. Ranks go by score and count,
    both descending, then by the phrase's bytes. An empty table has no rows; repeated rows count
    as often as they occur.
    """
    found = frequent(docs, min_count, sample, text, lang)
    levels = spelled(found)
    counts = found.where("k > 0").select("id", "n")
    totals = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    cuts = _parts(levels[1])
    for phrases in levels[2:]:
        cuts = cuts.unionByName(_parts(phrases))
    longer = _edges(levels)
    every = levels[1]
    for phrases in levels[2:]:
        every = every.unionByName(phrases)
    every = every.join(longer, "id", "left").where(
        F.coalesce(100 * F.col("longer"), F.lit(0)) < REPLACES * F.col("n"))
    every = every.join(totals, "lang")
    cuts = cuts.join(counts.select(F.col("id").alias("first"), F.col("n").alias("l")), "first") \
        .join(counts.select(F.col("id").alias("rest"), F.col("n").alias("r")), "rest")
    whole = "decimal(19,0)"
    scored = every.select("id", "lang", "phrase", F.col("n").alias("a"),
                          F.col("total").alias("n")).join(cuts, "id") \
        .withColumn("score", F.expr(
            f"(cast(a as {whole}) * cast(n as {whole}) * 1000) div "
            f"(cast(l as {whole}) * cast(r as {whole}))"))
    best = scored.groupBy("id").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"),
        *[F.first(name).alias(name) for name in ("lang", "phrase", "a", "n")])
    rows = best.select("lang", "phrase", "a", F.col("best.l").alias("l"),
                       F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
    return ranked(rows, first)


def _edges(levels: list[DataFrame]) -> DataFrame:
    """For each phrase the largest count of a phrase with one word more, before it or after it."""
    found = None
    for phrases in levels[2:]:
        cuts = _parts(phrases).join(phrases.select("id", "n", F.size("hashes").alias("k")), "id")
        both = cuts.where("cut = 1").select(F.col("rest").alias("id"), "n").unionByName(
            cuts.where("cut = k - 1").select(F.col("first").alias("id"), "n"))
        found = both if found is None else found.unionByName(both)
    return found.groupBy("id").agg(F.max("n").alias("longer"))


def ranked(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language; those of salted parts are chosen before they meet."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    chosen = salted.withColumn("place", place).where(F.col("place") <= first).drop("part", "place")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return chosen.withColumn("rank", place.cast("long")).where(F.col("rank") <= first) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
