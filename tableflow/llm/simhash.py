"""Near-duplicates by SimHash fingerprints that differ in few bits.

The pairs are found by the generalised pigeonhole principle. The fingerprint's bits are grouped
into partitions, correlated bits together, and each partition gets a threshold of its own; the
thresholds add up to the allowed distance less the partitions but one. Two fingerprints within the
distance then are within the threshold in at least one partition. A dynamic program chooses the
thresholds (-1: the partition isn't looked at) with the least expected work, for which it counts
how often all fingerprints agree in each partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import appended, texts
from tableflow.llm.components import components
from tableflow.scratch import ship_package, written

BITS = 64
SEED = 42
DISTANCE = 2
#: Numbers of partitions among which the expected work decides.
PARTITIONS = (2, 3, 4)
#: Buckets of up to this many fingerprints are compared pair by pair; fingerprints of larger ones
#: meet at the values one bit from them, which is as exact and linear.
PAIRWISE = 1024


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of the text's word shingles, with A-Z in lower case; 0 without words."""
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:len(words) - size]]).tolist()
    ends = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for low in range(0, len(starts), 1 << 16):
        found = np.array([digest(joined[a:b], SEED) for a, b in
                          zip(starts[low:low + (1 << 16)], ends[low:low + (1 << 16)])], "<u8")
        counts += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a long); a null text has no words."""
    ship_package(docs.sparkSession)

    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        own = np.array([fingerprint(one) for one in texts(batch.column("text"))], np.uint64)
        return [pa.array(own.view(np.int64))]

    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       docs[f"`{text}`"].alias("text"))
    return appended(rows, "fp long", found, drop=("text",))


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and for all pairs of bits how many have both (64 x 64)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            own = np.ascontiguousarray(np.asarray(batch.column("fp"), np.int64)).view(np.uint8)
            bits = np.unpackbits(own.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n += len(bits)
            both += np.rint(bits.T @ bits).astype(np.int64)
        if n:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(np.arange(-1, BITS * BITS)),
                "n": pa.array(np.concatenate([[n], both.reshape(-1)]))})

    rows = prints.select("fp").mapInArrow(sums, "at long, n long") \
        .groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    found = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        found[row["at"] + 1] = row["n"]
    return int(found[0]), found[1:].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in groups of like size; a group takes the bit most correlated with its bits."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    correlation = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    free, groups = set(range(BITS)), []
    for part in range(parts):
        size = len(free) // (parts - part)
        some = sorted(free)
        first = max(some, key=lambda bit: (correlation[bit, some].max(), -bit))
        group = [first]
        free.discard(first)
        while len(group) < size:
            some = sorted(free)
            strength = correlation[np.ix_(some, group)].mean(axis=1)
            group.append(some[int(np.argmax(strength))])
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def mask(bits: list[int] | tuple[int, ...]) -> int:
    """The bits as a signed 64-bit number."""
    value = sum(1 << bit for bit in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def agreeing_pairs(prints: DataFrame, masks: list[int]) -> list[int]:
    """For each mask, the pairs of fingerprints that are equal within it."""
    keys = prints.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(one).cast("long"))
                                                for one in masks])).alias("mask", "key"))
    counted = keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    pairs = counted.groupBy("mask").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("pairs"))
    found = {row["mask"]: row["pairs"] for row in pairs.collect()}  # a row for each mask
    return [found.get(i, 0) for i in range(len(masks))]


def expected_work(n: int, agreement: np.ndarray, group: list[int], pairs: int,
                  distance: int) -> list[float]:
    """By threshold -1, 0, ...: the keys to sort plus the pairs to verify in the partition.

    Pairs that differ in one or two bits are estimated from those that agree and from how likely
    each bit differs.
    """
    odds = [(1 - agreement[bit]) / agreement[bit] for bit in group]
    likely, work, keys, pairs = [1.0], [0.0], 1, max(pairs, 1)
    for order in range(distance + 1):
        if order:
            likely.append(sum(np.prod(chosen) for chosen in combinations(odds, order)))
            keys = len(list(combinations(group, order)))
        work.append(float(n * keys + pairs * sum(likely)))
    return work


def thresholds(work: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """The thresholds with the least work whose sum is the distance less the groups but one."""
    best = {0: (0.0, [])}  # by the sum of (threshold + 1)
    for group in work:
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for level, more in enumerate(group):
                found = (cost + more, [*chosen, level - 1])
                if total + level <= distance + 1 and \
                        (total + level not in following or found < following[total + level]):
                    following[total + level] = found
        best = following
    return best[distance + 1]


def plan(prints: DataFrame, distance: int = DISTANCE) -> list[int]:
    """The masks under which two fingerprints within the distance agree at least once.

    A partition with threshold t gives a mask for each choice of t of its bits, which are left
    out: fingerprints that differ in no more than those bits agree there.
    """
    n, both = bit_statistics(prints)
    share = np.diag(both) / max(n, 1)
    agreement = np.clip(share ** 2 + (1 - share) ** 2, 0.5, 1)
    options = [correlated_groups(n, both, parts) for parts in PARTITIONS]
    every = [group for groups in options for group in groups]
    pairs = iter(agreeing_pairs(prints, [mask(group) for group in every]))
    plans = []
    for groups in options:
        work = [expected_work(n, agreement, group, next(pairs), distance) for group in groups]
        cost, levels = thresholds(work, distance)
        plans.append((cost, [mask([bit for bit in group if bit not in left])
                             for group, level in zip(groups, levels) if level >= 0
                             for left in combinations(group, level)]))
    return min(plans)[1]


def _verified(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect what lies within the distance in each bucket, one less than nodes."""
    for batch in batches:
        left, right = [], []
        for bucket in batch.column("fps"):
            own = np.unique(np.asarray(bucket.values, np.int64)).view(np.uint64)
            near = np.bitwise_count(own[:, None] ^ own[None, :]) <= distance
            unseen = np.ones(len(own), bool)
            for first in range(len(own)):
                if not unseen[first]:
                    continue
                unseen[first] = False
                waiting = [first]
                while waiting:
                    at = waiting.pop()
                    new = np.flatnonzero(near[at] & unseen)
                    unseen[new] = False
                    waiting += new.tolist()
                    left += [own[at]] * len(new)
                    right += own[new].tolist()
        yield pa.RecordBatch.from_pydict({
            "a": pa.array(np.array(left, np.uint64).view(np.int64)),
            "b": pa.array(np.array(right, np.uint64).view(np.int64))})


def links(prints: DataFrame, distance: int = DISTANCE, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges a, b between distinct fingerprints within the distance of each other.

    The edges connect all that is connected; they aren't all pairs. Distances of more than two
    bits aren't supported for buckets of more than ``pairwise`` fingerprints.
    """
    masks = plan(prints, distance)
    keys = prints.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(one).cast("long")) for one in masks])).alias("mask", "key"))
    sizes = written(keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"),
                    "buckets")
    met = keys.join(sizes, ["mask", "key"])
    small = met.where(F.col("n") <= pairwise).groupBy("mask", "key") \
        .agg(F.collect_list("fp").alias("fps"))  # up to `pairwise` of them
    found = small.select("fps").mapInArrow(lambda rows: _verified(rows, distance),
                                           "a long, b long")
    if sizes.where(F.col("n") > pairwise).limit(1).count():
        if distance != 2:
            raise ValueError("buckets this large are only linked at a distance of two")
        hot = met.where(F.col("n") > pairwise).select("fp").distinct()
        bits = F.array(F.lit(0).cast("long"), *[F.lit(mask([bit])).cast("long")
                                                for bit in range(BITS)])
        around = hot.select("fp", F.explode(bits).alias("bit")) \
            .select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
        stars = around.groupBy("value").agg(F.collect_list("fp").alias("fps"))  # 65 at the most
        found = found.unionByName(stars.where(F.size("fps") > 1).select(
            F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    return found


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least id that can be reached by links.

    Documents without words have the fingerprint zero, which is linked like any other. A document
    without an id is linked, too, but names no component: where no document has an id, the
    component is null. Repeated rows are rows of their own.
    """
    prints = written(fingerprints(docs, doc_id, text), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = written(components(links(classes.select("fp"), distance)), "components")
    joined = classes.join(roots, classes["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(joined.select("fp", "root").join(least, "root")
                    .select(F.col("fp").alias("class"), "component_id"), "classes")
    return prints.join(named, prints["fp"] == named["class"]).drop("class")


def hexadecimal(fp: str) -> Column:
    """The fingerprint as 16 digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    distance: int = DISTANCE) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id, in own columns.

    Of repeated rows with that id and the same text one stays. Documents without an id can't be
    told from each other by a join: all of them stay.
    """
    return one_each(docs, near_duplicates(docs, doc_id, text, distance), doc_id, text)


def one_each(docs: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents whose ``doc_id`` is their group's ``component_id``."""
    kept = groups.where("doc_id = component_id") \
        .select(F.col("doc_id").alias("kept_id")).distinct()
    known = docs.where(docs[f"`{doc_id}`"].isNotNull())
    row = F.struct(F.lit(True).alias("__row"), *[known[f"`{name}`"] for name in docs.columns])
    rows = known.select(known[f"`{doc_id}`"].cast("long").alias("id"), row.alias("row"))
    rows = rows.join(kept, rows["id"] == kept["kept_id"], "left_semi")
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        rows = rows.withColumn("text", F.col(f"row.`{text}`")).dropDuplicates(["id", "text"])
    found = rows.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
    return found.unionByName(docs.where(docs[f"`{doc_id}`"].isNull()))
