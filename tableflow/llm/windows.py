"""Which windows of a fixed number of units also start in a document with a smaller id.

Units are bytes or words. The work is dealt out so that no document, passage or hot phrase has to
meet all others in one task:

1. Documents are dealt into *bundles* of some megabytes. A bundle cuts its documents into *runs*:
   consecutive windows that have the same *anchor*, the k units in them whose hash is least. Equal
   windows have equal anchors, so they are only looked for in the shard that the anchor's hash
   names.
2. Each bundle tells each shard its anchors' hashes and how many texts it has with each; the
   shards answer which of them other bundles have, too, and which are *crowded*: a phrase in very
   many contexts. Windows whose anchor only their own bundle has are done with.
3. Each bundle sends the texts of the remaining runs to their shards, each text once, with the
   least document id that has it there: copies are joined before the shuffle. The windows of
   crowded anchors go on their own, to the shards that their own hashes name, each once with its
   least id: so no shard gets all contexts of a phrase, however many there are.
4. A shard joins equal texts of all bundles, and a judge that is given (an induced suffix array,
   a relative Lempel-Ziv parse) finds the equal windows among what remains. It answers with a bit
   for each window.
5. Bundles put the answers together with a note of what was asked, which they sent themselves.
   A text's later documents need no answer: the window starts in the first.

The rows between these steps are compressed blocks, one for each bundle and shard. Hashes only
choose what is compared: texts and windows are equal if their bytes are. Windows of crowded anchors
are equal if two 64-bit hashes of them are.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm.arrow import text_bytes
from tableflow.scratch import ship_package

#: Text in a bundle, on average; and bundles whose remaining texts a shard gets, at the most.
BUNDLE_BYTES = 8 << 20
BUNDLES_A_SHARD = 4
#: Windows that are looked at together, and the text that a judge gets at once, about.
CHUNK = 1 << 16
JUDGED_BYTES = 3 << 20
#: Texts with one anchor, in all bundles, beyond which its windows are looked for one by one.
CROWDED = 4096
#: Classes of anchors within a shard, by which it can be worked off piece by piece.
CLASSES = 64

U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_MIX, _MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Multipliers of the polynomial hashes: of words, of anchors, and of longer spans.
_WORD, _ANCHOR, _FIRST = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with every bit spread over all others (splitmix64)."""
    values = (values ^ (values >> U(30))) * _MIX
    values = (values ^ (values >> U(27))) * _MIX2
    return values ^ (values >> U(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _WORD)


@lru_cache(maxsize=None)
def _inverse(multiplier: int) -> U:
    return U(pow(int(multiplier), -1, 1 << 64))


_known: dict[int, np.ndarray] = {}


def _powers(base: U, count: int) -> np.ndarray:
    """The first powers of the base; those that every chunk needs are kept."""
    most = CHUNK + 1024
    size = most if count <= most else count
    found = _known.get(int(base)) if size == most else None
    if found is None:
        found = np.full(size, base, np.uint64)
        found[0] = 1
        found = np.multiply.accumulate(found)
        if size == most:
            _known[int(base)] = found
    return found[:count]


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                multiplier: U) -> np.ndarray:
    """A polynomial hash of each span of unit hashes; equal spans have equal hashes."""
    n = len(units)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(units * _powers(_inverse(int(multiplier)), n), out=sums[1:])
    found = (sums[ends] - sums[starts]) * _powers(multiplier, n + 1)[starts]
    return mixed(found + (ends - starts).astype(np.uint64) * _MIX)


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of each word of the bytes; words follow each other."""
    found = np.empty(len(first), np.uint64)
    for low in range(0, len(first), 1 << 13):
        begin, end = first[low:low + (1 << 13)], last[low:low + (1 << 13)]
        at = begin[0]
        found[low:low + (1 << 13)] = span_hashes(_BYTE[data[at:end[-1]]], begin - at, end - at,
                                                 _WORD)
    return found


def word_heads(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each word's length and first seven bytes, which with its hash tell it from all others."""
    sizes = (last - first).astype(np.uint64)
    found = sizes << U(56)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for i in range(7):
        own = padded[first + i].astype(np.uint64) << U(8 * i)
        own[sizes <= U(i)] = 0
        found |= own
    return found


def blocks_of(units: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The hash of every ``size`` consecutive units; and of the largest power of two in it."""
    found, held = None, 0
    block, length = units, 1
    while True:
        if size & length:
            if found is None:
                found, held = block, length
            else:
                power = U(pow(int(_ANCHOR), length, 1 << 64))
                tail = block[held:held + len(found)]
                found = found[:len(tail)] * power
                found += tail
                held += length
        if 2 * length > size:
            return found, block, length
        power = U(pow(int(_ANCHOR), length, 1 << 64))
        longer = block[:max(len(block) - length, 0)] * power
        longer += block[length:]
        block, length = longer, 2 * length


def span_digests(blocks: np.ndarray, length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of units, made of the blocks that it is covered by."""
    sizes = ends - starts
    found = sizes.astype(np.uint64)
    for low in range(0, int(sizes.max()) if len(sizes) else 0, length):
        found ^= blocks[np.minimum(starts + low, ends - length)]
        found *= _MIX
        found ^= found >> U(29)
    return mixed(found)


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    length = 1
    while 2 * length <= size:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = size - length
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


@dataclass
class Texts:
    """Documents' texts as units one after the other, with the bytes that the units stand for."""

    data: np.ndarray  # all bytes
    documents: np.ndarray  # each document's first unit, and the end
    words: tuple[np.ndarray, np.ndarray] | None  # each word's first byte and end; None for bytes

    @property
    def units(self) -> int:
        return int(self.documents[-1])

    def hashes(self, start: int, end: int) -> np.ndarray:
        if self.words is None:
            return _BYTE[self.data[start:end]]
        if start >= end:
            return np.zeros(0, np.uint64)
        return word_hashes(self.data, self.words[0][start:end], self.words[1][start:end])

    def byte_spans(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of spans of units (of one unit at least)."""
        if self.words is None:
            return starts, ends
        return self.words[0][starts], self.words[1][ends - 1]


def as_bytes(column: pa.Array) -> Texts:
    data, offsets = text_bytes(column)
    return Texts(data, offsets.astype(np.int64), None)


def as_words(column: pa.Array) -> Texts:
    """The words (runs without white space), one space between them and after the last."""
    data, offsets = text_bytes(column)
    white = _WHITE[data]
    starts_word = ~white
    starts_word[1:] &= white[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts_word[begins] = ~white[begins]  # a document's first byte follows nothing
    ends_word = ~white
    ends_word[:-1] &= white[1:]
    ends_word[offsets[1:][np.diff(offsets) > 0] - 1] = ~white[offsets[1:][np.diff(offsets) > 0] - 1]
    first, last = np.flatnonzero(starts_word), np.flatnonzero(ends_word) + 1
    sizes = last - first + 1
    ends = np.cumsum(sizes)
    found = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    own, letters = ends - sizes, np.ones(len(found), bool)
    letters[ends - 1] = False
    found[letters] = data[~white]
    return Texts(found, np.searchsorted(first, offsets).astype(np.int64), (own, ends - 1))


@dataclass
class Runs:
    start: np.ndarray  # first unit
    windows: np.ndarray  # consecutive windows from there on
    anchor: np.ndarray  # the anchor's hash
    digest: np.ndarray  # a hash of the run's units


def runs_of(texts: Texts, size: int, anchor: int) -> Runs:
    """All windows of ``size`` units that lie in a document, by their anchors."""
    parts = []
    count = max(0, texts.units - size + 1)
    long = np.diff(texts.documents) >= size
    begins, ends = texts.documents[:-1][long], texts.documents[1:][long] - size + 1
    position = np.arange(CHUNK + size, dtype=np.uint64)
    for low in range(0, count, CHUNK):
        high = min(count, low + CHUNK)
        keys, blocks, length = blocks_of(texts.hashes(low, high + size - 1), anchor)
        ranked = keys * _MIX2
        ranked >>= U(20)
        ranked <<= U(20)
        ranked |= position[:len(keys)]
        least = sliding_minimum(ranked, size - anchor + 1) & U((1 << 20) - 1)
        i, j = np.searchsorted(ends, low, "right"), np.searchsorted(begins, high, "left")
        new = np.empty(high - low, bool)
        new[0] = True
        np.not_equal(least[1:], least[:-1], out=new[1:])
        firsts, lasts = np.maximum(begins[i:j], low) - low, np.minimum(ends[i:j], high) - low
        new[firsts] = True
        new[lasts[lasts < high - low]] = True
        start = np.flatnonzero(new)
        stop = np.append(start[1:], high - low)
        # between the documents' last windows and the next documents' first ones lie none
        inside = np.searchsorted(firsts, start, "right") - 1
        valid = inside >= 0
        valid[valid] = start[valid] < lasts[inside[valid]]
        start, stop = start[valid], stop[valid]
        if len(start):
            parts.append((start + low, stop - start, mixed(keys[least[start].astype(np.int64)]),
                          span_digests(blocks, length, start, stop + size - 1)))
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, *[np.zeros(0, np.uint64)] * 2)
    return Runs(*[np.concatenate(columns) for columns in zip(*parts)])


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted values without repeats."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def contained(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ones held."""
    if not len(held):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(held, values), len(held) - 1)
    return held[at] == values


def equal_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its group by equality in all keys, and each group's first row.

    Rows are sorted by the first key alone, which tells nearly all groups apart: rows that differ
    in another key between them split a group, which only costs a comparison later.
    """
    order = np.argsort(keys[0])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return group, np.minimum.reduceat(order, starts) if len(starts) else order


def same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray,
               sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``one`` on equal those from ``other`` on, for so many bytes."""
    same = np.ones(len(one), bool)
    for low in range(0, len(one), 1 << 14):
        part = slice(low, low + (1 << 14))
        own = sizes[part]
        starts = np.cumsum(own) - own
        unlike = gathered(data, one[part], one[part] + own) != \
            gathered(data, other[part], other[part] + own)
        same[part] = ~np.logical_or.reduceat(unlike, starts)
    return same


def text_groups(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span of bytes its group of equal texts, and each group's first span.

    The digests find the groups; the texts decide. A text that only shares another's digest is
    taken out of the group.
    """
    sizes = ends - starts
    group, example = equal_groups(digests)
    rows = np.flatnonzero(example[group] != np.arange(len(group)))
    first = example[group[rows]]
    alike = sizes[rows] == sizes[first]
    alike[alike] = same_bytes(data, starts[rows[alike]], starts[first[alike]], sizes[rows[alike]])
    odd = rows[~alike]
    group[odd] = len(example) + np.arange(len(odd))
    return group, np.append(example, odd)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The spans of bytes one after the other."""
    sizes = ends - starts
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return data[np.arange(total) + shift]


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    parts = [struct.pack("<I", len(arrays))]
    for array in arrays:
        array = np.ascontiguousarray(array)
        raw = array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes() \
            if array.itemsize > 1 and len(array) else array.tobytes()  # like bytes side by side
        parts += [struct.pack("<4sQ", array.dtype.str.encode(), len(array)), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueezed(block: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    at, found = 4, []
    for _ in range(struct.unpack_from("<I", data)[0]):
        kind, count = struct.unpack_from("<4sQ", data, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        at += 12
        raw = np.frombuffer(data, np.uint8, count * dtype.itemsize, at)
        if dtype.itemsize > 1 and count:
            raw = np.ascontiguousarray(raw.reshape(dtype.itemsize, count).T).reshape(-1)
        found.append(raw.view(dtype))
        at += count * dtype.itemsize
    return found


def in_order(table: pa.Table) -> pa.Table:
    """The documents by id, those of one id by text; documents without an id come last."""
    order = table.select(["doc_id", "text"]).append_column(
        "i", pa.array(np.arange(len(table)))).sort_by(
        [("doc_id", "ascending"), ("text", "ascending")]).column("i")
    return table.take(order)


#: What a judge gets: the texts' bytes, their ends, and the least ids. It returns for the windows
#: of every text, in order, whether the window also lies in a text with a smaller id.
Judge = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass
class Search:
    """Equal windows of ``size`` units whose anchors have ``anchor`` units."""

    size: int
    anchor: int
    units: Callable[[pa.Array], Texts]
    judge: Judge

    # --- in bundles -------------------------------------------------------------------------

    def bundle(self, table: pa.Table) -> "Bundle":
        table = in_order(table)
        texts = self.units(table.column("text"))
        runs = runs_of(texts, self.size, self.anchor)
        ids = table.column("doc_id")
        known = np.asarray(ids.is_valid())
        ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        document = np.searchsorted(texts.documents, runs.start, "right") - 1
        if not known.all():  # documents without an id take no part
            some = known[document]
            runs = Runs(*[getattr(runs, name)[some] for name in Runs.__dataclass_fields__])
            document = document[some]
        return Bundle(table, texts, runs, ids[document], self.size)

    # --- in shards --------------------------------------------------------------------------

    def answers(self, blocks: list[list[np.ndarray]]) -> list[bytes]:
        """A block with a bit for each window that the bundles sent."""
        bits = [np.zeros(int(block[1].sum()), bool) for block in blocks]
        ends = [np.cumsum(block[0]) for block in blocks]  # of the classes' rows
        byte_ends = [np.cumsum(block[3].astype(np.int64)) for block in blocks]
        window_ends = [np.cumsum(block[1].astype(np.int64)) for block in blocks]
        low = 0
        while low < CLASSES:
            high, size = low, 0
            while high < CLASSES and (high == low or size < JUDGED_BYTES):
                for end, byte_end in zip(ends, byte_ends):
                    size += int(_at(byte_end, end[high]) - _at(byte_end, _at(end, high)))
                high += 1
            pieces = []
            for i, (block, end) in enumerate(zip(blocks, ends)):
                a, b = int(_at(end, low)), int(end[high - 1])
                if b > a:
                    text = block[5][int(_at(byte_ends[i], a)):int(_at(byte_ends[i], b))]
                    pieces.append((i, int(_at(window_ends[i], a)),
                                   [block[k][a:b] for k in (1, 2, 3, 4)], text))
            if pieces:
                columns = zip(*[piece[2] for piece in pieces])
                found = self._judged(*map(np.concatenate, columns),
                                     np.concatenate([piece[3] for piece in pieces]))
                at = 0
                for i, first, (windows, *_), _ in pieces:
                    count = int(windows.sum())
                    bits[i][first:first + count] = found[at:at + count]
                    at += count
            low = high
        return [squeezed(np.packbits(own), np.packbits(single))
                for own, single in zip(bits, least_elsewhere(blocks))]

    def _judged(self, windows: np.ndarray, ids: np.ndarray, sizes: np.ndarray, tags: np.ndarray,
                data: np.ndarray) -> np.ndarray:
        windows, sizes = windows.astype(np.int64), sizes.astype(np.int64)
        ends = np.cumsum(sizes)
        group, example = text_groups(data, ends - sizes, ends,
                                     span_hashes(_BYTE[data], ends - sizes, ends, _FIRST))
        least = np.full(len(example), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        # an anchor with a single text has no other text to look in
        kinds, _ = equal_groups(tags[example])
        several = np.bincount(kinds)[kinds] > 1
        chosen = np.flatnonzero(several)
        rows = example[chosen]
        bits_of = np.full(len(example), -1, np.int64)  # where a text's answer begins
        judged = np.zeros(0, bool)
        if len(rows):
            text = gathered(data, ends[rows] - sizes[rows], ends[rows])
            judged = self.judge(text, np.cumsum(sizes[rows]), least[chosen])
            own = windows[rows]
            bits_of[chosen] = np.cumsum(own) - own
        found = np.repeat(ids > least[group], windows)
        asked = (ids == least[group]) & (bits_of[group] >= 0)
        counts = np.where(asked, windows, 0)
        within = np.repeat(asked, windows)
        position = np.arange(int(counts.sum())) + np.repeat(
            bits_of[group] - (np.cumsum(counts) - counts), counts)
        found[within] = judged[position]
        return found


def _at(ends: np.ndarray, i: int) -> int:
    return ends[i - 1] if i else 0


class Bundle:
    """A bundle's documents by id, and its runs."""

    def __init__(self, table: pa.Table, texts: Texts, runs: Runs, ids: np.ndarray, size: int):
        self.table, self.texts, self.runs, self.ids, self.size = table, texts, runs, ids, size

    def anchors(self, shards: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each shard, the sorted hashes of the bundle's anchors (48 bits of them), and how
        many texts have each."""
        _, example = equal_groups(self.runs.digest, self.runs.anchor)
        held = self.runs.anchor[example]
        shard = shard_of(held, shards)
        order = np.lexsort((held, shard))
        cut = np.flatnonzero(np.diff(shard[order])) + 1
        found = {}
        for part in np.split(order, cut):
            if len(part):
                keys = held[part] >> U(16)
                starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                found[int(shard[part[0]])] = keys[starts], np.diff(np.append(starts, len(keys)))
        return found

    def sent(self, shards: int, shared: np.ndarray,
             crowded: np.ndarray) -> tuple[dict[int, bytes], bytes]:
        """For each shard a block of texts, and of single windows, to look for; and a block for
        the bundle itself.

        ``shared`` are the anchors (sorted) that other bundles have, too, ``crowded`` those of
        them whose windows are looked for one by one. Anchors with several texts within the bundle
        are sent in any case. The bundle's own block has the runs that repeat a text of a smaller
        id in the bundle, the runs that the answers will be about, in the order of the shards, and
        the runs of crowded anchors with the places of their windows in the answers.
        """
        runs = self.runs
        first, last = self.texts.byte_spans(runs.start, runs.start + runs.windows + self.size - 1)
        group, example = text_groups(self.texts.data, first, last, runs.digest)
        least = self.ids[example]  # the first run's, as documents are in order
        keys = runs.anchor[example]
        kinds, _ = equal_groups(keys)
        wanted = np.bincount(kinds)[kinds] > 1 if len(kinds) else np.zeros(0, bool)
        wanted |= contained(keys >> U(16), shared)
        alone = contained(keys >> U(16), crowded)
        windows = self._windows(np.flatnonzero(alone[group]), shards)
        chosen = np.flatnonzero(wanted & ~alone)
        shard = shard_of(keys[chosen], shards)
        order = np.lexsort((example[chosen], class_of(keys[chosen]), shard))
        chosen, shard = chosen[order], shard[order]
        blocks = {}
        for part in np.split(np.arange(len(chosen)), np.flatnonzero(np.diff(shard)) + 1):
            if len(part):
                rows = example[chosen[part]]
                blocks[int(shard[part[0]])] = squeezed(
                    np.bincount(class_of(runs.anchor[rows]), minlength=CLASSES).astype(np.uint32),
                    runs.windows[rows].astype(np.uint16), self.ids[rows],
                    (last[rows] - first[rows]).astype(np.uint32),
                    (runs.anchor[rows] >> U(32)).astype(np.uint32),
                    gathered(self.texts.data, first[rows], last[rows]), *windows.of(int(shard[part[0]])))
        none = np.zeros(0, np.uint32)
        for number in windows.shards.difference(blocks):
            blocks[number] = squeezed(np.zeros(CLASSES, np.uint32), none.astype(np.uint16),
                                      none.astype(np.int64), none, none, none.astype(np.uint8),
                                      *windows.of(number))
        # what has the text of a sent one and is in a document of the same id is asked for, too
        place = np.full(len(example), -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        later = (self.ids > least[group]) & ~alone[group]
        asked = np.flatnonzero(~later & (place[group] >= 0))
        own = squeezed(runs.start[later].astype(np.uint32), runs.windows[later].astype(np.uint16),
                       runs.start[asked].astype(np.uint32), runs.windows[asked].astype(np.uint16),
                       place[group[asked]].astype(np.uint32),
                       runs.windows[example[chosen]].astype(np.uint16), shard.astype(np.uint32),
                       *windows.own)
        return blocks, own

    def _windows(self, rows: np.ndarray, shards: int) -> "_Windows":
        """The windows of these runs, equal ones joined, by the shards of their hashes."""
        runs = self.runs
        starts, counts = runs.start[rows], runs.windows[rows].astype(np.int64)
        one, other = window_hashes(self.texts, self.size, gathered_ranges(starts, counts))
        ids = np.repeat(self.ids[rows], counts)
        group, example = equal_groups(one, other)
        least = np.full(len(example), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        shard = shard_of(one[example], shards)
        order = np.lexsort((one[example], shard))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        example, shard = example[order], shard[order]
        return _Windows(one[example], other[example], least[order], shard, [
            starts.astype(np.uint32), counts.astype(np.uint32), place[group].astype(np.uint32),
            np.packbits(ids > least[group]), shard.astype(np.uint32)])


@dataclass
class _Windows:
    """A bundle's windows of crowded anchors, in the order of their shards."""

    one: np.ndarray  # two hashes of each
    other: np.ndarray
    least: np.ndarray  # its least id in the bundle
    shard: np.ndarray
    own: list[np.ndarray]  # what the bundle notes for itself

    @property
    def shards(self) -> set[int]:
        return set(np.unique(self.shard).tolist())

    def of(self, shard: int) -> list[np.ndarray]:
        low, high = np.searchsorted(self.shard, [shard, shard + 1])
        return [_steps(self.one[low:high]), self.other[low:high], self.least[low:high]]


def window_hashes(texts: Texts, size: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the units of each window that starts at one of these (sorted) units."""
    one, other = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        end = int(np.searchsorted(starts, low + CHUNK))
        units = texts.hashes(low, int(starts[end - 1]) + size)
        own = starts[at:end] - low
        one[at:end] = blocks_of(units, size)[0][own]
        other[at:end] = blocks_of(mixed(units ^ _FIRST), size)[0][own]
        at = end
    return mixed(one), mixed(other)


def least_elsewhere(blocks: list[list[np.ndarray]]) -> list[np.ndarray]:
    """For each block's windows whether another bundle has them with a smaller id."""
    sizes = [len(block[7]) for block in blocks]
    if not sum(sizes):
        return [np.zeros(0, bool) for _ in blocks]
    one = np.concatenate([np.cumsum(block[6], dtype=np.uint64) for block in blocks])
    other, ids = [np.concatenate([block[k] for block in blocks]) for k in (7, 8)]
    order = np.lexsort((other, one))
    one, other = one[order], other[order]
    new = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (other[1:] != other[:-1])))
    least = np.repeat(np.minimum.reduceat(ids[order], new), np.diff(np.append(new, len(order))))
    found = np.empty(len(order), bool)
    found[order] = ids[order] > least
    return np.split(found, np.cumsum(sizes)[:-1])


def repeated(units: int, own: bytes, answers: dict[int, bytes]) -> np.ndarray:
    """For each unit of a bundle, whether a window starts there that a smaller id has, too."""
    noted = unsqueezed(own)
    later, later_windows, start, windows, place, counts, shard = [
        column.astype(np.int64) for column in noted[:7]]
    found = np.zeros(units, bool)
    found[gathered_ranges(later, later_windows)] = True
    _mark_windows(found, noted[7:], answers)
    ends = np.cumsum(counts)
    bits = [np.zeros(0, bool)]
    for part in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
        if len(part):
            bits.append(np.unpackbits(unsqueezed(answers[int(shard[part[0]])])[0],
                                      count=int(counts[part].sum())).astype(bool))
    bits = np.concatenate(bits)
    answered = bits[gathered_ranges((ends - counts)[place], windows)]
    found[gathered_ranges(start, windows)[answered]] = True
    return found


def _mark_windows(found: np.ndarray, noted: list[np.ndarray], answers: dict[int, bytes]) -> None:
    """Mark the windows of crowded anchors that a smaller id has, here or in another bundle."""
    starts, counts, place, later, shard = noted
    if not len(starts):
        return
    elsewhere = []
    for part in np.split(shard, np.flatnonzero(np.diff(shard.astype(np.int64))) + 1):
        elsewhere.append(np.unpackbits(unsqueezed(answers[int(part[0])])[1],
                                       count=len(part)).astype(bool))
    gone = np.concatenate(elsewhere)[place] | np.unpackbits(later, count=len(place)).astype(bool)
    found[gathered_ranges(starts.astype(np.int64), counts.astype(np.int64))[gone]] = True


def gathered_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> U(20)) % U(shards)).astype(np.int64)


def class_of(keys: np.ndarray) -> np.ndarray:
    return (keys & U(CLASSES - 1)).astype(np.int64)


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """The units that lie in a window that starts where ``starts`` tells."""
    change = np.zeros(len(starts) + size + 1, np.int32)
    at = np.flatnonzero(starts)
    change[at] += 1
    change[at + size] -= 1
    return np.cumsum(change)[:len(starts)] > 0


def searched(docs: DataFrame, search: Search,
             finish: Callable[[pa.Table, Texts, np.ndarray], pa.Table],
             fields: T.StructType, doc_id: str, text: str, carried: list[str],
             bundle_bytes: int = BUNDLE_BYTES, crowded: int = CROWDED) -> DataFrame:
    """Each bundle's documents as ``finish`` makes them of their texts and the covered units.

    Anchors with more than ``crowded`` texts have their windows looked for one by one. ``carried``
    columns are at hand in the bundle's table, as the struct ``row``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    row = F.struct(F.lit(True).alias("__row"), *[F.col(f"`{name}`") for name in carried])
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       docs[f"`{text}`"].alias("text"), row.alias("row"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bundles = max(1, -(-total // bundle_bytes))
    shards = -(-bundles // BUNDLES_A_SHARD)
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "text"), F.lit(bundles)))

    def anchors(table: pa.Table) -> pa.Table:
        at = table.column("bundle")[0].as_py()
        found = search.bundle(table).anchors(shards)
        return _blocks(at, {shard: squeezed(_steps(keys), n.astype(np.uint32))
                            for shard, (keys, n) in found.items()})

    def shared(table: pa.Table) -> pa.Table:
        keys, n = zip(*[unsqueezed(block.as_py()) for block in table.column("block")])
        keys = [np.cumsum(steps, dtype=np.uint64) for steps in keys]
        every = np.concatenate(keys)
        order = np.argsort(every)
        every = every[order]
        starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        bundles_with = np.diff(np.append(starts, len(every)))
        texts = np.add.reduceat(np.concatenate(n)[order].astype(np.int64), starts)
        several = every[starts[bundles_with > 1]]
        many = every[starts[(bundles_with > 1) & (texts > crowded)]]
        return pa.table({"bundle": table.column("bundle"), "shard": table.column("shard"),
                         "block": pa.array([squeezed(np.packbits(contained(own, several)),
                                                     np.packbits(contained(own, many)))
                                            for own in keys], pa.binary())})

    def send(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        bundle = search.bundle(table)
        own, keys = bundle.anchors(shards), [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
        for shard, block in zip(told.column("shard").to_pylist(), told.column("block")):
            held = own[shard][0]
            for bits, found in zip(unsqueezed(block.as_py()), keys):
                found.append(held[np.unpackbits(bits, count=len(held)).astype(bool)])
        blocks, itself = bundle.sent(shards, *[np.sort(np.concatenate(found)) for found in keys])
        at = table.column("bundle")[0].as_py()
        return _blocks(at, {**blocks, -1 - at: itself})

    def answer(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:  # from bundles to themselves
            return table
        blocks = [unsqueezed(block.as_py()) for block in table.column("block")]
        return pa.table({"bundle": table.column("bundle"), "shard": table.column("shard"),
                         "block": pa.array(search.answers(blocks), pa.binary())})

    def end(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        table = in_order(table)
        texts = search.units(table.column("text"))
        answers = dict(zip(told.column("shard").to_pylist(),
                           [block.as_py() for block in told.column("block")]))
        itself = next(answers[shard] for shard in answers if shard < 0)
        return finish(table, texts, covered(repeated(texts.units, itself, answers), search.size))

    schema = "bundle long, shard long, block binary"
    by_bundle = rows.groupBy("bundle")
    told = by_bundle.applyInArrow(anchors, schema).groupBy("shard").applyInArrow(shared, schema)
    sent = by_bundle.cogroup(told.groupBy("bundle")).applyInArrow(send, schema)
    answered = sent.groupBy("shard").applyInArrow(answer, schema)
    return by_bundle.cogroup(answered.groupBy("bundle")).applyInArrow(end, fields)


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=U(0))


def _blocks(bundle: int, blocks: dict[int, bytes]) -> pa.Table:
    return pa.table({"bundle": pa.array([bundle] * len(blocks), pa.int64()),
                     "shard": pa.array(list(blocks), pa.int64()),
                     "block": pa.array(list(blocks.values()), pa.binary())})
