"""Quality rules and preference formatting against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tableflow.llm import chat, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    own = WORD.findall(text)
    windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    repeated = {i + k for i, window in enumerate(windows) if windows.count(window) > 1
                for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(own), sum(map(len, own)), sum(one in "#*$%&|<>" for one in text), len(lines),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated))


@pytest.mark.parametrize("text", [
    "", " \n\t ", "a", "a b c", "a b c a b c", "a a a a", "a b c d a b c b c d", "x\x0by\x0cz\rw",
    "one\none\n\none \n one", "#*$ %&|<> é # ", "a b c\na b c\nd\n\n\nd", "a\x1cb c\xa0d",
    "q w e r t z q w e z t q w e r"])
def test_measures(text):
    assert quality.measure(text) == brute_measures(text)


def test_hosts_reject_their_documents(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, "bad", bad if i % 10 else good, 1) for i in range(100)]
    rows += [(100 + i, f"host{i % 20}", good if i % 15 else bad, 2) for i in range(400)]
    rows += [(600, "one", bad, 3), (601, None, good, 4), (602, None, None, 5), (None, "one", good, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, kept int") \
        .repartition(3)
    found = quality.judged(docs).select("row.doc_id", "host", "base_failed", "kept").collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["kept"] == (not row["base_failed"] and row["host"] != "bad")
    verdicts = {row["host"]: row["host_rejected"]
                for row in quality.host_verdicts(quality.measured(docs)).collect()}
    assert verdicts["bad"] and not verdicts["host3"] and not verdicts[None]
    kept = quality.good_documents(docs)
    assert kept.schema == docs.schema
    assert sorted(row["kept"] for row in kept.collect()) == sorted(
        mark for _, host, text, mark in rows if text == good and host != "bad")
    assert quality.good_documents(docs.limit(0)).collect() == []
    assert quality.judged(docs.limit(0)).collect() == []


def test_a_prior_shrinks_small_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, f"host{i % 10}", good if i % 97 else bad) for i in range(5000)]
    rows += [(9000, "new", bad)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    rates = quality.measured(docs)
    verdicts = {row["host"]: row["host_rejected"]
                for row in quality.host_verdicts(rates, limit=0.99).collect()}
    assert not verdicts["new"]


def test_chance_is_no_variance(spark):
    """Rates of small hosts that only chance tells apart: the prior stays strong, so that a host
    with six failures of seven documents isn't rejected; hosts that truly differ make it weak."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rng = random.Random(5)
    alike = [(0, f"host{i}", bad if rng.random() < 0.3 else good) for i in range(300)
             for _ in range(10)]
    apart = [(0, f"host{i}", bad if rng.random() < (0.05 if i % 4 else 0.95) else good)
             for i in range(300) for _ in range(10)]
    odd = [(1, "odd", bad)] * 6 + [(1, "odd", good)]
    rejected = []
    for rows in (alike, apart):
        docs = spark.createDataFrame(rows + odd, "doc_id long, source string, text string")
        verdicts = {row["host"]: row["host_rejected"] for row in
                    quality.host_verdicts(quality.measured(docs)).collect()}
        rejected.append((verdicts["odd"], sum(verdicts.values())))
    assert rejected[0][0] is False and rejected[0][1] <= 3
    assert rejected[1][0] is True and 60 <= rejected[1][1] <= 90


TURNS = [  # pair, chosen, turn, role, text
    (1, True, 0, "system", "s"), (1, True, 1, "user", "u"), (1, True, 2, "assistant", "yes"),
    (1, False, 0, "system", "s"), (1, False, 1, "user", "u"), (1, False, 2, "assistant", "no"),
    (1, False, 3, "user", "?"),
    (2, True, 0, "user", "a"), (2, False, 0, "user", "a"),
    (3, True, 0, "user", "a"), (3, False, 0, "user", "b"),
    (4, True, 0, "user", "only"),
    (5, False, None, None, None), (5, True, 1, "user", "x"), (5, True, None, None, None),
    (6, True, 0, "user", "t"), (6, True, 0, "user", "t"), (6, False, 0, "user", "t"),
    (None, True, 0, "user", "lost"), (7, None, 0, "user", "lost"),
    (8, True, 0, "user", ""), (8, True, 1, "assistant", "a" * 50_000), (8, False, 0, "user", "")]


def test_preferences(spark):
    turns = spark.createDataFrame(
        TURNS, "pair_id long, side boolean, turn long, role string, text string").repartition(3)
    rows = chat.preferences(turns, F.col("pair_id"), F.col("side")).collect()
    found = {row["pair_id"]: row for row in rows}
    assert sorted(found) == [1, 2, 3, 4, 5, 6, 8]
    one = found[1]
    assert one["n_common"] == 2 and one["prompt"] == "<|system|>\ns\n<|user|>\nu\n"
    assert [tuple(s) for s in one["chosen"]] == [("<|assistant|>\n", False), ("yes\n", True)]
    assert [tuple(s) for s in one["rejected"]] == [
        ("<|assistant|>\n", False), ("no\n", True), ("<|user|>\n", False), ("?\n", False)]
    assert found[2]["n_common"] == 1 and found[2]["chosen"] == [] == found[2]["rejected"]
    assert found[3]["n_common"] == 0 and found[3]["prompt"] == ""
    assert found[4]["rejected"] is None and len(found[4]["chosen"]) == 2
    assert found[5]["n_common"] == 1 and found[5]["prompt"] == "<||>\n\n"
    assert found[6]["n_common"] == 1 and len(found[6]["chosen"]) == 2
    assert len(found[8]["chosen"][1]["content"]) == 50_001
    text = chat.preferences(turns, F.col("pair_id"), F.col("side")).where("pair_id = 1") \
        .select(chat.completion_text(F.col("chosen")), chat.completion_mask(F.col("rejected")))
    assert tuple(text.first()) == ("<|assistant|>\nyes\n", "14- 3+ 9- 2-")
    assert chat.preferences(turns.limit(0), F.col("pair_id"), F.col("side")).collect() == []


def test_preferences_stay_native(spark):
    turns = spark.createDataFrame(
        TURNS, "pair_id long, side boolean, turn long, role string, text string")
    plan = chat.preferences(turns, F.col("pair_id"), F.col("side"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
