"""Language-model scores: the base by brute force, the model by what a distribution must hold."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from samples import planted

from tableflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


@pytest.mark.parametrize("bundle_bytes", [3000, 1 << 23])
def test_base_equals_brute_force(documents, bundle_bytes):
    rows = planted()
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update([*WORD.findall(lower(text)), None])
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for doc_id, text in rows:
        own = [*WORD.findall(lower(text)), None]
        base = sum(math.log10((counts[one] + 0.5) / (n + 0.5 * (v + 1))) for one in own)
        wanted.append((doc_id, held_out(doc_id), len(own), sum(counts[one] > 0 for one in own),
                       n, round(base, 6)))
    found = mixing.scored(documents, bundle_bytes=bundle_bytes).collect()
    assert sorted([(*row[:5], round(row["base_score"], 6)) for row in found], key=repr) == \
        sorted(wanted, key=repr)
    assert all(row["score"] < 0 for row in found)
    for row in found:
        size = max(len((text or "").encode()) for doc_id, text in rows if doc_id == row["doc_id"])
        assert (row["bits_per_byte"] is None) == (size == 0)


def test_empty_tables(documents):
    assert mixing.scored(documents.limit(0)).collect() == []
    only = mixing.scored(documents.where("doc_id = 204 or doc_id = 202")).collect()
    assert len(only) == 2


def trained(texts):
    own = mixing.tokens(pa.array(texts))
    counts = mixing.no_counts()
    mixing.count(counts, own)
    predictors, mixer = mixing.Predictors(counts), mixing.Mixer.new()
    for _ in range(3):
        mixer.learn(predictors, own)
    return counts, predictors, mixer


def test_class_chances_sum_to_one():
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "b", "c", "dd"], k=30)) for _ in range(50)]
    _, predictors, mixer = trained(texts)
    contexts = [np.array([one], np.uint64) for one in (3 << 50, 5 << 51, 7 << 49)]

    class Every(mixing.Tokens):
        @property
        def classes(self):
            return np.arange(mixing.CLASSES)

        def contexts(self):
            return [np.repeat(context, mixing.CLASSES) for context in contexts]

    chances = 2 ** mixer.scores(predictors, Every(None, None, None, None))
    assert abs(chances.sum() - 1) < 1e-6


def test_contexts_see_two_tokens_of_the_same_text():
    own = mixing.tokens(pa.array(["a b A", "", None, "a b c"]))
    assert np.diff(own.offsets).tolist() == [4, 1, 1, 4]
    last, before, both = own.contexts()
    assert own.hashes[0] == own.hashes[2] and own.hashes[3] == own.hashes[4] == mixing.END
    assert last[0] == last[4] == last[5] == last[6] and before[0] == before[1] == before[7]
    assert last[1] == last[7] == last[3] and both[1] == both[7] and both[2] == both[8]
    assert both[0] != both[2]


def test_bits_are_counted_once():
    texts = ["a b c a", "b b"]
    counts = trained(texts)[0]
    assert all(table.sum() == mixing.CLASS_BITS * 8 for table in counts)


def test_model_beats_the_base_on_unseen_texts(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    follow = {one: rng.sample(words, 3) for one in words}

    def text():
        own = [rng.choice(words)]
        while len(own) < 60:
            own.append(rng.choice(follow[own[-1]]))
        return " ".join(own)

    docs = spark.createDataFrame([(i, text()) for i in range(600)], "doc_id long, text string")
    rows = [row for row in mixing.scored(docs.repartition(3)).collect() if row["held_out"]]
    base, score = (sum(row[name] for row in rows) for name in ("base_score", "score"))
    assert score > 0.75 * base


def test_large_counts_keep_their_shares():
    pairs = np.array([[1, 2], [0, (1 << 32) - 1], [1 << 32, 3 << 32], [1 << 40, 7], [0, 0]])
    assert mixing.fitted(pairs).tolist() == [
        [1, 2], [0, (1 << 32) - 1], [1 << 30, 3 << 30], [1 << 31, 0], [0, 0]]


def test_scores_do_not_depend_on_the_tables_split(documents):
    def scores(parts):
        rows = mixing.scored(documents.repartition(parts), bundle_bytes=3000).collect()
        return sorted((str(row["doc_id"]), row["n_tokens"], row["score"]) for row in rows)

    assert scores(1) == scores(7)
