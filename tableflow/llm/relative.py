"""Substring dedup by relative Lempel-Ziv parsing.

Shards (see ``windows``) are reference blocks: each holds all texts whose windows can meet there.
The texts of a block are parsed in the order of their documents' ids, each against an index of
all texts of smaller ids. A parse is greedy: where the index knows the window at hand, a factor is
copied from there as far as the two texts agree; else one word is passed over. The windows within
a factor are repeats. Those that reach over its end may be known from another text and are looked
up one by one.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm.arrow import WHITE, WORD
from tableflow.llm.windows import _FIRST, Search, Texts, as_words, searched, span_hashes, \
    word_hashes

SIZE = 50
ANCHOR = 8
_WORD = re.compile(WORD).finditer


def judge(data: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each window of the texts also lies in a text with a smaller id."""
    spaces = np.flatnonzero(data == 32)
    begins = ends - np.diff(ends, prepend=0)
    first = np.sort(np.concatenate([begins, spaces + 1]))
    last = np.sort(np.concatenate([ends, spaces]))
    words = word_hashes(data, first, last)
    from_word = np.searchsorted(first, begins)
    counts = np.diff(np.append(from_word, len(first))) - SIZE + 1
    start = np.arange(int(counts.sum())) + np.repeat(
        from_word - (np.cumsum(counts) - counts), counts)
    hashes = span_hashes(words, start, start + SIZE, _FIRST).tolist()
    bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    start, first, last = start.tolist(), first.tolist(), last.tolist()
    raw = data.tobytes()
    repeated = bytearray(len(hashes))
    index: dict[int, int] = {}  # a window's hash: where it stands first, as a number of a window
    end_of: list[int] = []  # each window's text's end, by number
    for low, high in zip(bounds, bounds[1:]):
        end_of += [high] * (high - low)
    order = np.argsort(ids, kind="stable").tolist()
    waiting: list[int] = []  # texts of the id at hand, indexed once all of them are parsed
    for at, text in enumerate(order):
        if at and ids[text] != ids[order[at - 1]]:
            _index(index, hashes, bounds, waiting)
            waiting = []
        waiting.append(text)
        here, high = bounds[text], bounds[text + 1]
        while here < high:
            there = index.get(hashes[here])
            if there is None:
                here += 1
                continue
            most = min(high - here, end_of[there] - there)
            length = 1
            while length < most and hashes[here + length] == hashes[there + length]:
                length += 1
            words_end, copied_end = start[here] + length - 1 + SIZE, start[there] + length - 1 + SIZE
            if raw[first[start[here]]:last[words_end - 1]] == \
                    raw[first[start[there]]:last[copied_end - 1]]:
                repeated[here:here + length] = b"\1" * length
                here += length
            else:  # unlike words of one hash
                here += 1
    return np.frombuffer(repeated, np.uint8).astype(bool)


def _index(index: dict[int, int], hashes: list[int], bounds: list[int], texts: list[int]) -> None:
    for text in texts:
        for at in range(bounds[text], bounds[text + 1]):
            index.setdefault(hashes[at], at)


WORDS = Search(SIZE, ANCHOR, as_words, judge)

FIELDS = T.StructType([T.StructField("doc_id", T.LongType()),
                       T.StructField("n_words", T.LongType()),
                       T.StructField("n_removed", T.LongType()),
                       T.StructField("kept_sha256", T.StringType())])


def _finished(table: pa.Table, texts: Texts, removed: np.ndarray, with_kept: bool) -> pa.Table:
    offsets = texts.documents
    first, last = texts.words
    kept = texts.data[np.repeat(~removed, last - first + 1)]
    sizes = np.concatenate([[0], np.cumsum(np.where(removed, 0, last - first + 1))])
    total = np.concatenate([[0], np.cumsum(removed)])
    raw = kept.tobytes()
    left = [raw[a:max(a, b - 1)] for a, b in zip(sizes[offsets[:-1]].tolist(),
                                                 sizes[offsets[1:]].tolist())]
    found = {
        "doc_id": table.column("doc_id"), "n_words": pa.array(np.diff(offsets)),
        "n_removed": pa.array(np.diff(total[offsets])),
        "kept_sha256": pa.array([hashlib.sha256(one).hexdigest() for one in left], pa.string())}
    if with_kept:
        kept = _cut_texts(table.column("text"), removed, offsets)
        found |= {"kept": pa.array(kept, pa.string()), "text": table.column("text"),
                  "row": table.column("row")}
    return pa.table(found)


def _cut_texts(texts: pa.ChunkedArray, removed: np.ndarray, offsets: np.ndarray) -> list[str | None]:
    """The texts without their removed words; a text that loses none is as it was."""
    total = np.concatenate([[0], np.cumsum(removed)])
    lost = (total[offsets[1:]] > total[offsets[:-1]]).tolist()
    return [cut_text(text, removed[first:end]) if some else text for text, some, first, end in
            zip(texts.to_pylist(), lost, offsets[:-1].tolist(), offsets[1:].tolist())]


def cut_text(text: str, removed: np.ndarray) -> str:
    """The text without these words and the white space after them; all other stays as it is.

    Where the last words go, the white space before them goes, too.
    """
    spans = [word.span() for word in _WORD(text)]
    kept, at = [], 0
    for start, end in runs(removed):
        kept.append(text[at:spans[start][0]])
        at = spans[end][0] if end < len(spans) else len(text)
    return "".join([*kept, text[at:]]) if at < len(text) else "".join(kept).rstrip(WHITE)


def runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """The first place and the end of each run of marked places."""
    change = np.diff(marked.astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    with_kept: bool = False) -> DataFrame:
    """Per document: its words, those removed, and the digest of the rest.

    A word goes if a window of 50 words that covers it also starts in a document with a smaller
    id. Documents of one id are no copies of each other's; a document without an id keeps all its
    words and takes none from others; a null text has no words. ``with_kept`` adds ``kept``, the
    text without what was removed (its other white space stays), the ``text`` as it was, and
    ``row``, the document's other columns.
    """
    def finish(table: pa.Table, texts: Texts, removed: np.ndarray) -> pa.Table:
        return _finished(table, texts, removed, with_kept)

    carried = [name for name in docs.columns if name != text] if with_kept else []
    fields = FIELDS
    if with_kept:
        row = T.StructType([T.StructField("__row", T.BooleanType(), False),
                            *[docs.schema[name] for name in carried]])
        fields = T.StructType([*FIELDS.fields, T.StructField("kept", T.StringType()),
                               T.StructField("text", T.StringType()), T.StructField("row", row)])
    return searched(docs, WORDS, finish, fields, doc_id, text, carried)


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            length: str | None = None) -> DataFrame:
    """The documents without their repeats, in their own columns.

    Documents that hold no repeat keep their texts as they are. From the others the repeats are cut
    with the white space after them; documents of which no word is left go. ``length`` names a
    column that holds the text's characters and follows the change.
    """
    found = without_repeats(docs, doc_id, text, with_kept=True)
    found = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = F.col("n_removed") > 0
    columns = {name: F.col(f"row.`{name}`") for name in docs.columns if name != text}
    columns[text] = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    if length is not None:
        columns[length] = F.when(changed, F.length("kept").cast(docs.schema[length].dataType)) \
            .otherwise(columns[length])
    return found.select(*[columns[name].alias(name) for name in docs.columns])
