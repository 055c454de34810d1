"""SimHash groups and weighted samples against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from samples import planted, words

from tableflow.llm import simhash, weighted
from tableflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    own = WORD.findall(text)
    shingles = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] or [" ".join(own)] * bool(own)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    least = list(range(len(prints)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return [root(i) for i in range(len(prints))]


def near_rows():
    rng = random.Random(5)
    rows = planted()
    for group in range(4):
        base = words(rng, 400)
        for copy in range(6):
            changed = list(base)
            changed[rng.randrange(400)] = "Xx"
            rows.append((300 + 10 * group + copy, " ".join(changed)))
    return rows


@pytest.mark.parametrize("pairwise", [1024, 2])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash.links, "__defaults__", (2, pairwise))
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = simhash.near_duplicates(docs).select(
        "doc_id", simhash.hexadecimal("fp"), "component_id").collect()
    prints = [brute_fingerprint(text or "") for _, text in rows]
    roots = brute_components(prints)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    wanted = [(doc_id, f"{value:016x}", least.get(root))
              for (doc_id, _), value, root in zip(rows, prints, roots)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert max(Counter(row[2] for row in wanted).values()) >= 5


def test_one_representative_stays(documents):
    kept = simhash.representatives(documents)
    assert kept.schema == documents.schema
    ids = [row["doc_id"] for row in kept.collect()]
    assert 200 not in ids and 201 not in ids and ids.count(None) == 1
    rows = simhash.near_duplicates(documents).where("doc_id = component_id").collect()
    assert sorted(i for i in ids if i is not None) == sorted({row["doc_id"] for row in rows})


def test_no_documents_no_texts_and_other_columns(spark, documents):
    assert simhash.near_duplicates(documents.limit(0)).collect() == []
    assert simhash.representatives(documents.limit(0)).collect() == []
    rows = [(1, None, "x", 5), (2, "", "x", 5), (3, " \n", "x", 5), (None, None, "x", 5),
            (4, "a b c " * 30_000, "x", 5), (5, "a b c " * 30_000, "x", 5), (5, "a b c " * 30_000, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    kept = simhash.representatives(docs)
    assert kept.schema == docs.schema
    assert sorted((row["doc_id"] or 0, row["fp"], row["component_id"]) for row in kept.collect()) == [
        (0, "x", 5), (1, "x", 5), (4, "x", 5)]


def test_thresholds_are_the_best():
    work = [[0, 5, 9, 30], [0, 1, 2, 3], [0, 4, 4, 50]]
    cost, levels = simhash.thresholds(work, 2)
    every = [(work[0][a + 1] + work[1][b + 1] + work[2][c + 1], [a, b, c])
             for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    assert (cost, levels) == min(every)


def test_masks_hold_every_near_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300)
    prints = spark.createDataFrame([(int(value),) for value in base], "fp long")
    masks = simhash.plan(prints)
    for value in base[:50]:
        for first in range(64):
            for second in range(64):
                other = int(value) ^ (1 << first) ^ (1 << second)
                assert any((int(value) ^ other) & one % (1 << 64) == 0 for one in masks)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, rng.randrange(101, 150)) for _ in range(60)]
    edges += [(7, 7), (200, 201), (201, 200)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = dict(map(tuple, rows))
    assert len(found) == len(rows)
    assert all(found[i] == 0 for i in range(41)) and found[201] == 200
    assert {found[b] for a, b in edges if a == 100} == {100} and 7 in found
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_compared_with_next(documents):
    rows = sorted(planted(), key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    found = weighted.compared_with_next(documents).collect()
    held = {(row["doc_id"], row["n_chars"]): row for row in found}
    assert len(found) == len(rows)
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        row = held[doc_id, len(text)]
        count = len(text) // 4
        changed = text[:len(text) - count] + after[:count]
        if doc_id != 207:
            assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    prints = {}
    for row, text in [(held[d, len(t or "")], t or "") for d, t in rows]:
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
    assert weighted.compared_with_next(documents.limit(0)).collect() == []
    assert weighted.compared_with_next(documents.where("doc_id = 208")).first()["near_next"] == 1


def test_samples_estimate_the_similarity():
    rng = random.Random(9)
    errors = []
    for _ in range(60):
        one = words(rng, 300)
        other = one[:rng.randrange(300)] + words(rng, rng.randrange(1, 300))
        terms = [Counter(own) + Counter(zip(own, own[1:])) for own in (one, other)]
        exact = sum((terms[0] & terms[1]).values()) / sum((terms[0] | terms[1]).values())
        a, b = weighted.signatures([" ".join(one), "\n".join(other)])
        errors.append(weighted.likeness(a[None], b[None])[0] - exact)
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.25


def test_fingerprints_keep_the_rows(documents):
    rows = weighted.fingerprinted(documents).collect()
    assert len(rows) == documents.count() and all(len(row["fingerprint"]) == 128 for row in rows)


@pytest.mark.parametrize("count", [100_000, 300_000])
def test_unrelated_long_texts_are_unlike(count):
    one, other = (" ".join(f"{mark}{i}" for i in range(count)) for mark in "ab")
    a, b = weighted.signatures([one, other])
    assert weighted.likeness(a[None], b[None])[0] < 0.1


def test_long_edited_texts_have_their_similarity():
    rng, errors = random.Random(4), []
    for share in (0.9, 0.75, 0.5, 0.3):
        for count in (2_000, 50_000, 120_000):
            one = [f"w{rng.randrange(1 << 40)}" if rng.random() < 0.7 else rng.choice("abcdefgh")
                   for _ in range(count)]
            kept = int(count * share)
            other = one[:kept] + [f"x{rng.randrange(1 << 40)}" for _ in range(count - kept)]
            terms = [Counter(own) + Counter(zip(own, own[1:])) for own in (one, other)]
            exact = sum((terms[0] & terms[1]).values()) / sum((terms[0] | terms[1]).values())
            a, b = weighted.signatures([" ".join(one), " ".join(other)])
            errors.append(weighted.likeness(a[None], b[None])[0] - exact)
    assert np.abs(errors).max() < 0.2 and np.abs(errors).mean() < 0.07
    assert abs(np.mean(errors)) < 0.05


def test_signatures_do_not_depend_on_chunks(monkeypatch):
    texts = [" ".join(f"w{i % 997} v{i}" for i in range(5000))]
    whole = weighted.signatures(texts)
    monkeypatch.setattr(weighted, "CHUNK", 100)
    assert (weighted.signatures(texts) == whole).all()
