"""Byte and word windows that also start in documents of smaller ids, against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from samples import planted

from tableflow.llm import relative, suffixes, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, units, join, size):
    """Per row the removed units, by a table of the least id that each window starts in."""
    least = {}
    for doc_id, text in rows:
        own = units(text or "")
        if doc_id is None:
            continue
        for i in range(len(own) - size + 1):
            key = join(own[i:i + size])
            least[key] = min(least.get(key, doc_id), doc_id)
    found = []
    for doc_id, text in rows:
        own = units(text or "")
        gone = [False] * len(own)
        for i in range(len(own) - size + 1 if doc_id is not None else 0):
            if least[join(own[i:i + size])] < doc_id:
                gone[i:i + size] = [True] * size
        kept = join([one for one, out in zip(own, gone) if not out])
        spans = sum(out and not (i and gone[i - 1]) for i, out in enumerate(gone))
        found.append((doc_id, len(own), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def as_bytes(text):
    return list(text.encode())


def as_words(text):
    return [word.encode() for word in WORD.findall(text)]


@pytest.fixture(params=["one bundle", "many bundles", "crowded anchors", "some crowded"])
def bundles(request, monkeypatch):
    if request.param != "one bundle":
        crowded = {"many bundles": windows.CROWDED, "crowded anchors": 0, "some crowded": 5}
        monkeypatch.setattr(windows.searched, "__defaults__", (4000, crowded[request.param]))


def test_bytes_equal_brute_force(documents, bundles):
    found = suffixes.without_repeats(documents)
    wanted = brute_force(planted(), as_bytes, bytes, suffixes.SIZE)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    assert sum(row[2] for row in wanted) > 1000


def test_words_equal_brute_force(documents, bundles):
    found = relative.without_repeats(documents)
    wanted = brute_force(planted(), as_words, b" ".join, relative.SIZE)
    wanted = [(doc_id, n, gone, digest) for doc_id, n, gone, _, digest in wanted]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert sum(row[2] for row in wanted) > 300


def test_cleaned_documents_keep_their_columns(documents):
    found = relative.cleaned(documents, length="n_chars")
    assert found.schema == documents.schema
    rows = {row["doc_id"]: row for row in found.collect()}
    texts = dict(planted())
    assert rows[208]["text"] == texts[208]
    assert 200 not in rows and 201 not in rows  # nothing is left of copies
    assert rows[202]["text"] == "" and rows[203]["text"] is None
    assert all(row["n_chars"] == len(row["text"] or "") for row in rows.values())


def test_empty_table(spark, documents):
    assert relative.without_repeats(documents.limit(0)).collect() == []
    assert suffixes.without_repeats(documents.limit(0)).collect() == []


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffix_array_and_prefixes(letters):
    rng = np.random.default_rng(letters)
    for size in [1, 2, 3, 10, 60, 200]:
        text = rng.integers(97, 97 + letters, size).astype(np.uint8)
        raw = text.tobytes()
        order = suffixes.suffix_array(text, 200)
        assert order.tolist() == sorted(range(size), key=lambda i: raw[i:])
        common = suffixes.permuted_prefixes(text, order, 50)
        for before, at in zip(order, order[1:]):
            length = 0
            while length < min(50, size - max(before, at)) and \
                    raw[before + length] == raw[at + length]:
                length += 1
            assert common[at] == length


def test_a_phrase_in_every_document_is_spread_over_shards():
    """A shard does not get all contexts of a phrase: its windows go to many shards."""
    rng = np.random.default_rng(3)
    phrase, rows = "the same words stand in every text of them ", []
    for i in range(600):
        around = ["".join(chr(97 + c) for c in rng.integers(0, 26, 80)) for _ in range(2)]
        rows.append((i, around[0] + phrase + around[1]))
    parts = [pa.table({"doc_id": pa.array([i for i, _ in rows[k::6]], pa.int64()),
                       "text": pa.array([text for _, text in rows[k::6]])}) for k in range(6)]
    bundles = [suffixes.BYTES.bundle(part) for part in parts]
    keys = [np.concatenate([np.repeat(key, n) for key, n in bundle.anchors(8).values()])
            for bundle in bundles]
    every, n = np.unique(np.concatenate(keys), return_counts=True)
    assert n.max() > 300  # texts with one anchor
    most = []
    for crowded in (every[:0], every[n > 100]):
        loads = np.zeros(8)
        for bundle in bundles:
            blocks, _ = bundle.sent(8, every[n > 1], crowded)
            for shard, block in blocks.items():
                loads[shard] += sum(column.nbytes for column in windows.unsqueezed(block))
        most.append(loads.max() / loads.mean())
    assert most[0] > 3 and most[1] < 1.5


def test_runs_cover_every_window_once():
    text = "".join(chr(97 + i * i % 23) for i in range(3000))
    texts = windows.as_bytes(pa.array([text, "", "kurz", text[:60], None]))
    runs = windows.runs_of(texts, 50, 20)
    starts = windows.gathered_ranges(runs.start, runs.windows)
    assert starts.tolist() == [*range(2951), *range(3004, 3015)]
