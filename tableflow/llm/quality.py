"""Quality rules for documents, and for the hosts that they come from.

Every document is measured by itself. The failures of each rule are then counted by host; a host's
rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts' rates, so
that a host of three documents isn't judged by three documents alone. A host fails where a shrunk
rate passes the limit, and all its documents are rejected with it.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import WHITE, WORD, appended, texts
from tableflow.scratch import ship_package, written

#: Rules by which hosts are judged, as SQL over the measures; the first two also judge documents.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("short", "repetitive")
#: A host fails a rule if more than this share of its documents is expected to fail.
#: Variances of rates below this are rounding.
LEAST_VARIANCE = 1e-12
HOST_LIMIT = 0.5

MEASURES = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
            "n_repeat_words long")
_words = re.compile(WORD).findall


def measure(text: str) -> tuple[int, int, int, int, int, int]:
    """Words, their characters, symbols, lines with a word, repeats among them, repeated words.

    A line counts as repeated if an earlier line of the text equals it. A word counts as repeated
    if it lies in a window of three words that the text holds twice or more.
    """
    words = _words(text)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    counts = Counter(windows)
    if len(counts) < len(windows):
        end = 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines),
            len(lines) - len(set(lines)), repeated)


def _measures(batch: pa.RecordBatch) -> list[pa.Array]:
    found = [measure(text) for text in texts(batch.column("text"))]
    return [pa.array(column, pa.int64()) for column in zip(*found)] if found else \
        [pa.array([], pa.int64())] * 6


def measured(docs: DataFrame, text: str = "text", host: str = "source",
             keep: list[str] | None = None) -> DataFrame:
    """``row`` (all columns, or those to keep), ``host``, the measures and ``base_failed``.

    A null text has no words. A null host is a host like any other.
    """
    ship_package(docs.sparkSession)
    kept = docs if keep is None else docs.select(*[F.col(f"`{name}`") for name in keep])
    rows = docs.select(F.struct(F.lit(True).alias("__row"), *[kept[f"`{name}`"] for name in kept.columns]).alias("row"),
                       docs[f"`{host}`"].cast("string").alias("host"),
                       docs[f"`{text}`"].alias("text"))
    failed = F.expr(" or ".join(f"({RULES[name]})" for name in BASE))
    return appended(rows, MEASURES, _measures, drop=("text",)).withColumn("base_failed", failed)


def host_verdicts(documents: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures by rule, and whether the host is rejected.

    The prior of a rule is a beta distribution with the mean and the variance that the rate has
    over the hosts (method of moments), less what chance alone makes rates of few documents vary.
    Hosts that are all alike, up to chance, have no variance: the prior then weighs as much as all
    documents of an average host. Hosts with a null name are one host.
    """
    counts = documents.groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *[F.sum(F.expr(rule).cast("long")).alias(f"n_{name}") for name, rule in RULES.items()])
    moments = [F.avg("n_docs").alias("docs_mean"),
               F.avg(F.lit(1.0) / F.col("n_docs")).alias("chance")]
    for name in RULES:
        rate = F.col(f"n_{name}") / F.col("n_docs")
        moments += [F.avg(rate).alias(f"mean_{name}"), F.var_pop(rate).alias(f"var_{name}")]
    prior = counts.agg(*moments).first()  # one row of numbers
    failed = F.lit(False)
    for name in RULES:
        mean, spread = prior[f"mean_{name}"] or 0.0, prior[f"var_{name}"] or 0.0
        # A rate p of n documents varies by p (1 - p) / n on its own.
        variance = spread - (prior["chance"] or 1.0) * mean * (1 - mean)
        weight = max((1 - prior["chance"]) * mean * (1 - mean) / variance - 1, 0.0) \
            if variance > LEAST_VARIANCE else prior["docs_mean"]
        shrunk = (F.col(f"n_{name}") + mean * (weight or 0.0)) / (F.col("n_docs") + (weight or 0.0))
        failed = failed | (shrunk > limit)
    return counts.select("host", "n_docs", *[f"n_{name}" for name in RULES],
                           failed.alias("host_rejected"))


def judged(docs: DataFrame, text: str = "text", host: str = "source",
           limit: float = HOST_LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` with the columns to keep of every document, its measures, ``base_failed``, ``kept``.

    The measures are written once and read for the hosts' rates and for the verdicts. Repeated
    rows are judged one by one.
    """
    found = written(measured(docs, text, host, list(keep)), "quality")
    verdicts = host_verdicts(found, limit).select(F.col("host").alias("judged_host"),
                                                  "host_rejected")
    joined = found.join(verdicts, found["host"].eqNullSafe(verdicts["judged_host"]), "left")
    return joined.drop("judged_host").withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False)))


def good_documents(docs: DataFrame, text: str = "text", host: str = "source",
                   limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that the rules keep, with all their columns and nothing else.

    The texts are measured once for the hosts' rates and once for the documents' own verdicts, so
    that no text is shuffled or stored: only the names of rejected hosts meet the documents. They
    are written first: Spark then knows their size, and sends them to all tasks if they are few.
    """
    verdicts = host_verdicts(measured(docs, text, host, []), limit)
    rejected = written(verdicts.where("host_rejected")
                       .select(F.col("host").alias("judged_host")), "rejected_hosts")
    found = measured(docs, text, host).where("not base_failed")
    kept = found.join(rejected, found["host"].eqNullSafe(rejected["judged_host"]), "left_anti")
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
