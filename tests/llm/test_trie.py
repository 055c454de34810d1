"""Words by the trie against the unchanged library and a plain merge."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import planted
from tokenizers import Tokenizer

from tableflow.llm import trie

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(5)
    letters = "aAbétzZ'’.,!? \n\t0159ñ<|> ́日😀\x0b\x1f\x1c\x00-_ſİß"
    return ["", " ", "it's 'tis we'll", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>",
            "<|endoftext|><|endoftext|> x", "a" * 5000, "ab" * 3000, "한국어 조합 ①²Ⅷ ½ ﬁ", *[
                "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
                for _ in range(1500)]]


def test_ids_and_names_are_the_librarys(library):
    whole = odd_texts() + [text or "" for _, text in planted()]
    for text, parts in zip(whole, trie.words(PATH).results(whole)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert [int(number) for part in parts for number in part[1].split()] == ids, text
        assert sum(part[0] for part in parts) == len(ids)
        assert " ".join(part[2] for part in parts) == library.decode(ids, skip_special_tokens=False)


def test_traversal_equals_merging_each_word_alone():
    merges = trie.words(PATH).merges
    rng = random.Random(7)
    found = {"".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 14))) for _ in range(400)}
    found |= {word[:rng.randint(1, len(word))] for word in found}  # words that are prefixes
    encoded = dict(merges.encoded(found))
    assert set(encoded) == found
    for word, ids in encoded.items():
        symbols = [merges.inner[symbol] for symbol in word[:-1]] + [merges.final[word[-1]]]
        assert ids == merges.merge(symbols)


def test_shared_prefixes_are_looked_at_once(monkeypatch):
    merges = trie.words(PATH).merges
    ends = []
    visit = type(merges).visit
    monkeypatch.setattr(type(merges), "visit", lambda self, word, end, *rest: (
        ends.append(word[:end]), visit(self, word, end, *rest))[1])
    found = ["thinking", "thinker", "think", "thin"]
    dict(merges.encoded(found))
    assert sorted(ends) == sorted({word[:end] for word in found for end in range(1, len(word))})


def test_what_is_remembered_is_bounded(monkeypatch, library):
    monkeypatch.setattr(trie, "KEPT_BYTES", 2000)
    own = trie.Words(PATH)
    for text in ("one two three", "two four five six", "seven eight nine two", "ten one two"):
        [parts] = own.results([text])
        assert [int(n) for p in parts for n in p[1].split()] == library.encode(
            text, add_special_tokens=False).ids
        assert len(own.known) <= 8


def test_digests_keep_every_row(spark, documents, library):
    rows = trie.digests(documents.withColumn("n_tokens", F.lit("own")), PATH).select(
        "row.doc_id", "row.n_tokens", "row.text", F.col("n_tokens").alias("n"), "ids_sha256",
        "decoded_sha256").collect()
    assert len(rows) == documents.count()
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == "own" and row["n"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_ids_as_arrays_and_empty_tables(spark, library):
    docs = spark.createDataFrame([(1, "Hello, World!"), (2, None), (3, "")], "id long, body string")
    found = {row["row"]["id"]: row["ids"] for row in trie.encoded(docs, PATH, "body").collect()}
    assert found == {1: library.encode("Hello, World!", add_special_tokens=False).ids, 2: [], 3: []}
    assert trie.digests(docs.limit(0), PATH, "body").count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        trie.Words(public_tokenizers.path("byte_bpe_50k.json"))
