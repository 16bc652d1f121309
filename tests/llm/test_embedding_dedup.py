import math

import corpora
import numpy as np
from punctua.llm import embedding_dedup as operator

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, digest string, vector string, part int"


def vectors(spark, cells, ids=None):
    rows = [(ids[i] if ids else i, None if c is None else [None if x is None else float(x) for x in c], 1, 2, "d", "v", 3)
            for i, c in enumerate(cells)]
    return spark.createDataFrame(rows, SCHEMA)


def expected(cells, cosine=0.9):
    linked, degree = [], [0] * len(cells)
    unit = []
    for c in cells:
        good = c is not None and len(c) and all(x is not None and math.isfinite(x) for x in c)
        v = np.array(c, np.float32).astype(float) if good else np.zeros(1)
        unit.append(v / np.linalg.norm(v) if good and np.linalg.norm(v) else None)
    for i, a in enumerate(unit):
        for j in range(i):
            if a is not None and unit[j] is not None and len(a) == len(unit[j]) and a @ unit[j] >= cosine:
                linked.append((i, j))
                degree[i] += 1
                degree[j] += 1
    return degree, corpora.components(len(cells), linked)


def check(spark, cells):
    found = {r.vec_id: r for r in operator.near_vectors(vectors(spark, cells).repartition(5)).collect()}
    degree, groups = expected(cells)
    assert [found[i].n_links for i in range(len(cells))] == degree
    assert [found[i].component_id for i in range(len(cells))] == groups


def clouds(rng, sizes, spread, dimensions=32):
    out = []
    for size, width in zip(sizes, spread):
        center = rng.standard_normal(dimensions)
        out += list(center + width * rng.standard_normal((size, dimensions)))
    return out


def test_matches_brute_force(spark):
    rng = np.random.default_rng(16)
    cells = clouds(rng, [1] * 200 + [5] * 40 + [150, 90], [0] * 200 + [0.15] * 40 + [0.1, 0.3])
    cells += [cells[3]] * 70 + [cells[210]] * 2 + [2 * cells[4]]
    cells += [None, [], [0.0] * 32, [None] * 32, [math.nan] * 32, [math.inf] + [1.0] * 31, [1.0, 0.0], [1.0, 0.001], [-0.0] * 32]
    check(spark, cells)


def test_large_components_with_and_without_a_core(spark, monkeypatch):
    monkeypatch.setattr(operator, "BLOCK", 32)
    rng = np.random.default_rng(17)
    check(spark, clouds(rng, [1] * 50 + [300, 200, 100], [0] * 50 + [0.1, 0.33, 0.25]))


def test_repeated_ids_and_empty_table(spark):
    rows = operator.near_vectors(vectors(spark, [[1.0, 2.0]] * 3 + [[2.0, -1.0]], ids=[None, 5, 5, None])).collect()
    assert sorted((r.n_links, r.component_id or -1) for r in rows) == [(0, -1), (2, 5), (2, 5), (2, 5)]
    assert operator.near_vectors(vectors(spark, [])).collect() == []


def test_more_nodes_need_more_passes():
    assert operator.passes(1) == 1 and operator.passes(10**4) < operator.passes(10**6) < operator.passes(10**9) < 1000


def crowded(rng, size, dimensions=64):
    """Unit vectors of pairwise cosine 0.8 or so, every twentieth with another at 0.901."""
    unit = lambda v: v / np.linalg.norm(v)
    center, out = unit(rng.standard_normal(dimensions)), []
    for i in range(size):
        side = rng.standard_normal(dimensions)
        out.append(math.sqrt(0.8) * center + math.sqrt(0.2) * unit(side - (side @ center) * center))
        if i % 20 == 0:
            side = rng.standard_normal(dimensions)
            out.append(0.901 * out[-1] + math.sqrt(1 - 0.901**2) * unit(side - (side @ out[-1]) * out[-1]))
    return out


def test_links_in_a_crowd_are_all_found(spark):
    rng = np.random.default_rng(18)
    check(spark, crowded(rng, 2500) + list(rng.standard_normal((500, 64))))


def test_crowd_takes_more_passes_where_blocks_are_many(spark, monkeypatch):
    monkeypatch.setattr(operator, "BLOCK", 4)
    monkeypatch.setattr(operator, "ROUND", 40)
    cells = crowded(np.random.default_rng(19), 1000)
    found = spark.createDataFrame([(i, c.tobytes()) for i, c in enumerate(cells)], "uid long, vector binary")
    links = operator.all_links(found, 0.9, 16, 1e-3).collect()
    groups = corpora.components(len(cells), [(r.a, r.b) for r in links])
    wanted = expected([c.tolist() for c in cells])[1]
    assert sum(a != b for a, b in zip(groups, wanted)) <= 2


def test_windows_hold_across_ranges(spark):
    angles = np.linspace(0, 40, 500)
    cells = [[math.cos(math.radians(a)), math.sin(math.radians(a))] for a in angles]
    check(spark, cells)
