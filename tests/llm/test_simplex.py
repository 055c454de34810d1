"""Clusters by simplex projection against plain rounds over all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest
from compare import TABLES_DIR, duck, duck_result, spark_result

from tableflow.llm import queries, simplex

FIELDS = "vec_id long, embedding array<float>, cluster string, row string"


def plain(rows, k=8, rounds=10):
    kept = [(vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector])
            for vec_id, vector, *_ in rows
            if vector is not None and len(vector) == 64
            and all(x is not None and math.isfinite(x) for x in vector)]
    order = sorted(kept, key=lambda row: (hashlib.sha256(
        f"3:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]))
    centroids = [row[1] for row in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(vector, c)), number)
                    for number, c in enumerate(centroids)) for _, vector in kept]

    for _ in range(rounds):
        of = [number for _, number in assign()]
        for number in range(len(centroids)):
            own = [vector for (_, vector), cluster in zip(kept, of) if cluster == number]
            if own:
                centroids[number] = [sum(part) // len(own) for part in zip(*own)]
    found = assign()
    sums = [sum(d for d, number in found if number == c) for c in range(len(centroids))]
    return sorted([(vec_id, number, distance, sums[number], sum(sums), hashlib.sha256(
        ",".join(map(str, centroids[number])).encode()).hexdigest())
        for (vec_id, _), (distance, number) in zip(kept, found)], key=repr)


def clusters(spark, rows, **more):
    table = spark.createDataFrame([(*row, "own", "too") for row in rows], FIELDS).repartition(3)
    found = simplex.clustered(table, **more)
    return sorted([(row["row"]["vec_id"], *row[1:]) for row in found.collect()], key=repr)


def vectors(rng, count, spread=0.1):
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(number, [x + rng.gauss(0, spread) for x in rng.choice(centres)])
            for number in range(count)]


def test_query_equals_sql(spark):
    name = "op13_simplex_clusters"
    assert spark_result(queries.QUERIES[name](spark, TABLES_DIR)) == duck_result(
        duck(TABLES_DIR), queries.ORACLES[name])


def test_odd_rows_and_repeats(spark):
    rng = random.Random(3)
    rows = vectors(rng, 120)
    rows += [(rows[0][0], rows[0][1]), (500, rows[1][1]), (None, rows[2][1]), (None, rows[3][1])]
    rows += [(600, None), (601, [1.0] * 63), (602, [1.0] * 65), (603, []),
             (604, [1.0] * 63 + [None]), (605, [math.nan] + [1.0] * 63),
             (606, [math.inf] * 64), (607, [-math.inf] + [0.0] * 63)]
    assert clusters(spark, rows) == plain(rows)


def test_ties_equal_vectors_and_few(spark):
    same = [(number, [0.5] * 64) for number in range(20)]
    assert clusters(spark, same) == plain(same)
    line = [(number, [float(number % 4)] + [0.0] * 63) for number in range(16)]  # one dimension
    assert clusters(spark, line) == plain(line)
    few = vectors(random.Random(4), 3)
    assert clusters(spark, few) == plain(few)
    assert clusters(spark, []) == []
    assert clusters(spark, [(1, [1.0] * 3)]) == []


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(number, [float(rng.choice([-3e5, 0.0, 3e5]))] + [rng.random() for _ in range(63)])
            for number in range(60)]
    assert clusters(spark, rows) == plain(rows)


def test_too_large_components_end_the_job(spark):
    with pytest.raises(Exception, match="too large"):
        clusters(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (8, 64))
    data = np.floor(centres[rng.integers(0, 8, 4000)] + rng.normal(0, 40, (4000, 64))).astype(int)
    points = data[:8].copy()
    over = simplex.Simplex.over(data[100:108])
    places, apexes = over.apexes(points), over.apexes(data)
    maybe = simplex.possible(apexes, places)
    exact = np.stack([simplex.squared(data, point) for point in points], 1)
    assert maybe[np.arange(len(data)), exact.argmin(1)].all()
    assert maybe.mean() < 0.7  # else the bounds would spare little
    plane = ((apexes[:, None, :-1] - places[None, :, :-1]) ** 2).sum(2)
    gap = apexes[:, -1:] - places[None, :, -1]
    total = apexes[:, -1:] + places[None, :, -1]
    assert (plane + gap ** 2 <= exact * (1 + 1e-9) + 1e-3).all()
    assert (plane + total ** 2 >= exact * (1 - 1e-9) - 1e-3).all()
    cluster, distance = simplex.nearest(data, apexes, points, places)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
