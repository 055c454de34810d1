"""Suffix-array dedup: removes byte strings that also start in a document with a smaller id.

A shard (see ``windows``) writes its texts one after the other and sorts their suffixes by induced
sorting: suffixes are classified as smaller or larger than their successor; the substrings from
one leftmost smaller suffix to the next are sorted by an induction and named; their order as
suffixes follows from the names recursively; and the order of all suffixes is induced from theirs
in two linear scans. The scans handle a bucket of one first byte at a time, as vectors. Common
prefixes of neighbours are then computed in text order (permuted).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tableflow.llm.windows import Search, Texts, as_bytes, searched

SIZE = 50
ANCHOR = 28
#: Stands behind each text: no UTF-8 text holds this byte.
END = 0xFF


def smaller_suffixes(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the last one is larger than nothing)."""
    n = len(text)
    found = np.zeros(n, bool)
    if n < 2:
        return found
    rises = text[:-1] < text[1:]
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = np.searchsorted(differs, np.arange(n - 1))  # the next place of two unlike bytes
    known = following < len(differs)
    found[:-1][known] = rises[differs[following[known]]]
    return found


def induced(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The suffix array, given the leftmost smaller suffixes in their order."""
    n = len(text)
    seeds = _by_byte(text, leftmost)
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger[text[n - 1]].append(np.array([n - 1]))
    larger_done = [np.zeros(0, np.int64)] * 256
    for byte in range(256):
        found = []
        waiting = larger[byte]
        while waiting:
            items = np.concatenate(waiting)
            found.append(items)
            waiting = larger[byte] = []
            before = items[items > 0] - 1
            _deal(text, before[~smaller[before]], larger)
            waiting = larger[byte]
        if found:
            larger_done[byte] = np.concatenate(found)
        if len(seeds[byte]):
            before = seeds[byte][seeds[byte] > 0] - 1
            _deal(text, before[~smaller[before]], larger)
    rising: list[list[np.ndarray]] = [[] for _ in range(256)]
    parts = []
    for byte in range(255, -1, -1):
        found = []
        waiting = rising[byte]
        while waiting:
            items = np.concatenate(waiting)
            found.append(items)
            rising[byte] = []
            before = items[items > 0] - 1
            _deal(text, before[smaller[before]], rising)
            waiting = rising[byte]
        items = larger_done[byte][::-1]
        before = items[items > 0] - 1
        _deal(text, before[smaller[before]], rising)
        parts += found + [items]
    return np.concatenate(parts)[::-1]


def _by_byte(text: np.ndarray, positions: np.ndarray) -> list[np.ndarray]:
    own = text[positions]
    order = np.argsort(own, kind="stable")
    return np.split(positions[order], np.cumsum(np.bincount(own, minlength=256))[:-1])


def _deal(text: np.ndarray, positions: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append the positions to the buckets of their bytes, in their order."""
    if not len(positions):
        return
    own = text[positions]
    order = np.argsort(own, kind="stable")
    ordered = positions[order]
    counts = np.bincount(own, minlength=256)
    ends = np.cumsum(counts)
    for byte in np.flatnonzero(counts):
        buckets[byte].append(ordered[ends[byte] - counts[byte]:ends[byte]])


def substring_names(text: np.ndarray, places: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the substrings between leftmost smaller suffixes; equal ones have one name.

    ``places`` are the suffixes in text order, ``ordered`` the same sorted by their substrings.
    """
    n = len(text)
    index = np.zeros(n, np.int64)
    index[places] = np.arange(len(places))
    lengths = np.append(np.diff(places) + 1, 0)  # the last has no end: equal to no other
    own = lengths[index[ordered]]
    same = (own[1:] == own[:-1]) & (own[1:] > 0)
    active = np.flatnonzero(same)
    depth = 0
    while len(active):
        differ = text[ordered[active] + depth] != text[ordered[active + 1] + depth]
        same[active[differ]] = False
        depth += 1
        active = active[~differ & (own[active] > depth)]
    names = np.empty(len(places), np.int64)
    names[index[ordered]] = np.cumsum(np.append(True, ~same)) - 1
    return names


def name_order(names: np.ndarray, span: int, needed: int) -> np.ndarray:
    """The order of the suffixes of a string of names, each of which stands for ``span`` units.

    Neighbouring names are named as pairs, and the pairs' string is sorted in the same way, until
    all names differ or stand for as many units as count.
    """
    most = int(names.max()) + 1 if len(names) else 0
    if most == len(names) or span >= needed:
        return np.argsort(names, kind="stable")
    step = max(1, span // 2)  # substrings are two bytes long at least
    second = np.zeros(len(names), np.int64)
    second[:-step or None] = names[step:] + 1
    pairs = names * (most + 1) + second
    order = np.argsort(pairs)
    ordered = pairs[order]
    paired = np.empty(len(names), np.int64)
    paired[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
    return name_order(paired, 2 * span, needed)


def suffix_array(text: np.ndarray, needed: int = SIZE) -> np.ndarray:
    """All suffixes in the order of their first ``needed`` bytes at least."""
    if len(text) < 2:
        return np.arange(len(text))
    smaller = smaller_suffixes(text)
    places = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(places) > 1:
        first = induced(text, smaller, places)
        is_place = np.zeros(len(text), bool)
        is_place[places] = True
        names = substring_names(text, places, first[is_place[first]])
        places = places[name_order(names, 2, needed + 2)]
    return induced(text, smaller, places)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in text order, how many bytes (``most`` at the most) it has in common with
    the suffix before it in the array."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (n + most + 8,), (1,))
    found = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for depth in range(0, most, 8):
        unlike = words[active + depth] ^ words[before[active] + depth]
        lowest = unlike & (~unlike + np.uint64(1))
        bits = np.where(unlike > 0, np.bitwise_count(lowest - np.uint64(1)), 64)
        found[active] += bits.astype(np.int64) // 8
        active = active[unlike == 0]
    limit = n - np.maximum(np.arange(n), before)  # nothing is common beyond the text
    return np.minimum(np.minimum(found, most), limit)


def judge(data: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each window of the texts also lies in a text with a smaller id."""
    sizes = np.diff(ends, prepend=0)
    text = np.full(len(data) + len(ends), END, np.uint8)
    number = np.repeat(np.arange(len(ends)), sizes)
    text[np.arange(len(data)) + number] = data
    del number
    begins = ends - sizes + np.arange(len(ends))
    order = suffix_array(text)
    common = permuted_prefixes(text, order, SIZE)
    counts = sizes - SIZE + 1
    owner = np.repeat(np.arange(len(ends)), counts)
    starts = np.arange(len(owner)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    owner_at = np.full(len(text), -1, np.int64)
    owner_at[starts] = owner
    inside = order[owner_at[order] >= 0]  # equal windows stand together: none ends within
    new = np.ones(len(inside), bool)
    new[1:] = common[inside[1:]] < SIZE
    # a neighbour that is no window can stand between two unlike windows only
    own = ids[owner_at[inside]]
    least = np.minimum.reduceat(own, np.flatnonzero(new))
    repeated = np.zeros(len(text), bool)
    repeated[inside] = own > least[np.cumsum(new) - 1]
    return repeated[starts]


BYTES = Search(SIZE, ANCHOR, as_bytes, judge)

FIELDS = T.StructType([T.StructField("doc_id", T.LongType()),
                       T.StructField("n_bytes", T.LongType()),
                       T.StructField("n_removed", T.LongType()),
                       T.StructField("n_spans", T.LongType()),
                       T.StructField("kept_sha256", T.StringType())])


def _finished(table: pa.Table, texts: Texts, removed: np.ndarray) -> pa.Table:
    offsets = texts.documents
    total = np.concatenate([[0], np.cumsum(removed)])
    first = removed.copy()
    first[1:] &= ~removed[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = removed[begins]
    spans = np.concatenate([[0], np.cumsum(first)])
    kept = texts.data[~removed]
    own = offsets - total[offsets]
    view = memoryview(np.ascontiguousarray(kept))
    digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(own[:-1], own[1:])]
    columns = {"doc_id": table.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)),
               "n_removed": pa.array(np.diff(total[offsets])),
               "n_spans": pa.array(np.diff(spans[offsets])),
               "kept_sha256": pa.array(digests, pa.string()),
               "kept": pa.array([view[a:b].tobytes() for a, b in zip(own[:-1], own[1:])],
                                pa.binary()),
               "text": table.column("text"), "row": table.column("row")}
    return pa.table(columns)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    with_kept: bool = False) -> DataFrame:
    """Per document: its bytes, those removed, the runs that were removed, and the rest's digest.

    A byte goes if a 50-byte string that covers it also starts in a document with a smaller id.
    Documents of one id are no copies of each other's; a document without an id keeps all its
    bytes and takes none from others; a null text is empty. ``with_kept`` adds the bytes that are
    left, as binary (characters can be cut), the ``text`` as it was, and ``row``, the document's
    other columns.
    """
    def finish(table: pa.Table, texts: Texts, removed: np.ndarray) -> pa.Table:
        return _finished(table, texts, removed).select(fields.fieldNames())

    carried = [name for name in docs.columns if name != text] if with_kept else []
    fields = FIELDS
    if with_kept:
        row = T.StructType([T.StructField("__row", T.BooleanType(), False),
                            *[docs.schema[name] for name in carried]])
        fields = T.StructType([*FIELDS.fields, T.StructField("kept", T.BinaryType()),
                               T.StructField("text", T.StringType()), T.StructField("row", row)])
    return searched(docs, BYTES, finish, fields, doc_id, text, carried)
