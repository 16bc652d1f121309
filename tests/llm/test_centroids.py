import hashlib
import math

import duckdb
import numpy as np
import pytest
from compare import differences
from punctua.llm import centroids as C
from punctua.llm.oracles import CENTROIDS
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cells string, cluster int, distance string"


def frame(spark, vectors, ids=None):
    rows = [(ids[i] if ids else i, v, 1, "v", "c", 9, "d") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(vectors, ids, k=8, rounds=10, seed=3):
    """Per kept row ``(id, cluster, distance, cluster inertia, inertia, centroid)``, in Python integers."""
    kept = [
        (i, [max(-C.LARGEST, min(C.LARGEST, math.floor(1024 * float(np.float32(x))))) for x in v]) for i, v in zip(ids, vectors)
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    cells = [np.array(v, np.int32).tobytes() for _, v in kept]
    order = sorted(range(len(kept)), key=lambda r: (
        kept[r][0] is None, hashlib.sha256(f"{seed}:{kept[r][0]}".encode()).hexdigest() if kept[r][0] is not None else "", cells[r]))
    goals = [kept[r][1] for r in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, g)), c) for c, g in enumerate(goals)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(goals)):
            own = [v for (_, v), (_, chosen) in zip(kept, found) if chosen == c]
            if own:
                goals[c] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    inertia = [sum(d for d, chosen in found if chosen == c) for c in range(len(goals))]
    return [(i, c, d, inertia[c], sum(inertia), goals[c]) for (i, _), (d, c) in zip(kept, found)]


def collected(found):
    return [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found.collect()]


def test_transform_is_exact_and_coarse_to_fine():
    matrix = C.hadamard()
    assert (matrix @ matrix.T == 64 * np.eye(64)).all()
    assert ((np.diff(matrix, axis=1) != 0).sum(axis=1) == np.arange(64)).all()
    rng = np.random.default_rng(1)
    x, y = rng.integers(-C.LARGEST, C.LARGEST + 1, (2, 50, 64))
    apart = C.transformed(x) - C.transformed(y)
    assert [sum(int(v) ** 2 for v in row) for row in apart] == [64 * sum(int(v) ** 2 for v in row) for row in x - y]


@pytest.mark.parametrize("k", [1, 3, 8])
def test_search_is_exact_with_ties(k):
    rng = np.random.default_rng(k)
    for spread in (2, 50, 2**20):
        x, goals = rng.integers(-spread, spread + 1, (400, 64)), rng.integers(-spread, spread + 1, (k, 64))
        goals[k // 2] = goals[0]
        x[:k] = goals
        x[k:2 * k] = (goals[0] + goals[-1]) // 2
        chosen, distance = C.nearest(C.transformed(x), C.transformed(goals))
        wanted = ((x[:, None] - goals[None]) ** 2).sum(axis=2)
        assert (chosen == wanted.argmin(axis=1)).all() and (distance == wanted.min(axis=1)).all()


def odd_vectors(count=120):
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 1, (5, 64))
    vectors = [[float(np.float32(x)) for x in middles[i % 5] + rng.normal(0, 0.4, 64)] for i in range(count)]
    vectors[10:50] = [vectors[0]] * 40  # one vector in a third of the rows
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [0.0] * 64, [-0.0005] * 64]
    return vectors + odd


def test_matches_sql_and_brute_force(spark):
    vectors = odd_vectors()
    ids = [None if i in (3, 60) else 5 if i in (8, 9) else i for i in range(len(vectors))]
    docs = frame(spark, vectors, ids)
    assert sorted(collected(C.clusters(docs)), key=str) == sorted(brute_force(vectors, ids), key=str)
    plain = frame(spark, vectors)
    duck = duckdb.connect()
    duck.register("embeddings", plain.select("vec_id", "embedding").toArrow())
    assert differences(C.clusters(plain).withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid"),
                       duck, CENTROIDS) == []


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, count):
    vectors = [[float(i)] * 64 for i in range(count)]
    assert sorted(collected(C.clusters(frame(spark, vectors)))) == sorted(brute_force(vectors, range(count)))


def test_empty_clusters_stay_and_large_components_are_held(spark):
    vectors = [[1.0] * 64] * 12 + [[3e38] * 64, [-3e38] * 64]
    found = collected(C.clusters(frame(spark, vectors)))
    assert sorted(found) == sorted(brute_force(vectors, range(14)))


def test_sums_are_one_row_per_centroid_and_task(spark):
    whole = C.integers(frame(spark, odd_vectors())).repartition(4)
    goals = C.starts(whole, 8, 3)
    assert whole.select("cells").mapInArrow(C._sums(goals), "cluster long, n long, sums array<long>").count() <= 32
