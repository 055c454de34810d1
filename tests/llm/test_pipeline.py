"""The pipeline and the registered queries over a small table, against brute force."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import duck, duck_result, spark_result
from samples import TABLES, planted, words
from test_quality import brute_measures
from test_repeats import WORD
from test_similar import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tableflow.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_pipeline(rows):
    """(doc_id, text) that the stages keep, with the texts that they leave."""
    good = []
    for doc_id, text in rows:
        n_words, _, _, _, _, repeated = brute_measures(text or "")
        if n_words >= 50 and 100 * repeated <= 50 * n_words:
            good.append((doc_id, text))
    roots = brute_components([brute_fingerprint(text) for _, text in good])
    groups = defaultdict(list)
    for (doc_id, text), root in zip(good, roots):
        groups[root].append((doc_id, text))
    kept = {min(own) for own in groups.values()}
    least = {}
    for doc_id, text in kept:
        own = WORD.findall(text)
        for i in range(len(own) - 49):
            key = tuple(own[i:i + 50])
            least[key] = min(least.get(key, doc_id), doc_id)
    found = {}
    for doc_id, text in kept:
        own = WORD.findall(text)
        gone = set()
        for i in range(len(own) - 49):
            if least[tuple(own[i:i + 50])] < doc_id:
                gone.update(range(i, i + 50))
        if len(gone) < len(own):
            found[doc_id] = cut(text, gone)
    return found


def cut(text, gone):
    """The text's words and white space, without those words and the white space after them."""
    parts = re.split(r"([ \t\n\v\f\r]+)", text)
    left, number = [], -1
    for part in parts:
        if part and not part.isspace():
            number += 1
        if number not in gone:
            left.append(part)
    found = "".join(left)
    return found.rstrip(" \t\n\v\f\r") if number in gone else found


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, text) for i, text in planted(3, 80) if i is not None]
    rows = list({i: (i, text) for i, text in rows}.values())
    rows += [(400 + i, rows[i][1]) for i in range(10)] + [(500, " ".join(words(rng, 30)))]
    spark.createDataFrame([(i, text, "en", f"src{i % 4}", len(text or "")) for i, text in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS, name
    wanted = brute_pipeline(rows)
    assert 20 < len(wanted) < len(rows) - 10
    assert {row["doc_id"]: row["text"] for row in docs.collect()} == wanted
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    held = defaultdict(dict)
    for piece in pieces:
        held[piece["doc_id"]][piece["start"]] = (piece["length"], piece["ids_crc32"])
    assert set(held) == set(wanted)
    for doc_id, text in wanted.items():
        ids, at = tokenizer.encode(text, add_special_tokens=False).ids + [0], 0
        for start, (length, digest) in sorted(held[doc_id].items()):
            part = np.array(ids[at:at + length], "<u4")
            assert start == at and zlib.crc32(part.tobytes()) == digest
            at += length
        assert at == len(ids)


def test_pipeline_of_no_documents_and_of_odd_ones(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string"
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(None, None, None, None, None, "x"), (1, None, "en", "a", 0, "x"), (2, "", "en", None, 0, "x"),
            (3, long, "en", "a", len(long), "x"), (3, long, "en", "a", len(long), "x"),
            (4, long, None, None, len(long), "x"), (None, long[:4000], "en", "b", 4000, "x")]
    for name, made in (("none", []), ("odd", rows)):
        folder = tmp_path / name
        spark.createDataFrame(made, schema).write.parquet(str(folder / "documents.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(folder))
            assert docs.schema.fieldNames() == [*COLUMNS, "ids"]
        left = sorted((row["doc_id"] or 0, row["ids"]) for row in docs.collect())
        assert left == ([] if name == "none" else [(0, "x"), (3, "x")])
        pieces = corpus_pipeline.run(spark, str(folder)).collect()
        assert {row["doc_id"] for row in pieces} == (set() if name == "none" else {None, 3})


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert {name.split("_")[0] for name in queries.ORACLES} == {
        "op1", "op3", "op5", "op6", "op11", "op13"}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert spark_result(queries.QUERIES[name](spark, TABLES)) == \
        duck_result(duck(TABLES), queries.ORACLES[name])


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if name not in queries.ORACLES])
def test_query_runs_over_the_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, TABLES).collect()
    assert {row["doc_id"] for row in rows} == set(range(200))
