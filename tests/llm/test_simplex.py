"""K-means by n-simplex bounds: against DuckDB and plain Python over all centroids."""

import hashlib
import math

import numpy as np
import pytest

from barlake.llm import simplex_clusters as sc
from barlake.llm.queries import ORACLE_SQL, REGISTRY
from tests.oracle import both, connect


def brute(rows, clusters=8, rounds=10):
    fine = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    points = [[math.floor(1024 * x) for x in v] for _, v in fine]
    order = sorted(range(len(fine)), key=lambda k: (fine[k][0] is None, hashlib.sha256(f"3:{fine[k][0]}".encode()).hexdigest() if fine[k][0] is not None else "", points[k]))
    centres = [points[k] for k in order[:clusters]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        best = [min((apart(p, c), j) for j, c in enumerate(centres)) for p in points]
        if r < rounds:
            for j in range(len(centres)):
                own = [p for p, (_, k) in zip(points, best, strict=True) if k == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = {j: sum(d for d, k in best if k == j) for j in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, inertia[j], sum(inertia.values()), digest[j]) for (i, _), (d, j) in zip(fine, best, strict=True)]


def table(spark, rows):
    full = [(i, v, "x", "y", "z") for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, v string, cluster string, apex string")


def key(r):
    return tuple((x is None, x or 0) for x in r[:3])


def check(spark, rows):
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted((tuple(r) for r in sc.clustered(table(spark, rows).repartition(3)).collect()), key=key)
    assert got == sorted(brute(single), key=key)
    return got


def test_query_against_sql(spark, oracle_sf):
    got, want, names, sql_names = both(REGISTRY["op12_simplex_clusters"](spark, oracle_sf), connect(oracle_sf), ORACLE_SQL["op12_simplex_clusters"])
    assert names == sql_names and got == want and len(got) == 500


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, list(map(float, rng.normal(size=64)))) for i in range(60)]
    rows += [(None, rows[3][1]), (None, rows[4][1]), (7, rows[8][1]), (7, rows[7][1]), (7, rows[7][1]), (900, [0.0] * 64)]
    rows += [(901, None), (902, []), (903, [1.0] * 63), (904, [1.0] * 65), (905, [1.0] * 63 + [None]), (906, [1.0] * 63 + [math.nan]), (907, [1.0] * 63 + [math.inf])]
    assert len(check(spark, rows)) == 66


@pytest.mark.parametrize("n", [0, 1, 3, 9])
def test_few_vectors(spark, n):
    check(spark, [(i, [float(i % 4)] * 64) for i in range(n)])


def test_ties_repeats_and_flat_data(spark):
    """All vectors on one line or in a few places: most pivots add no altitude, distances tie."""
    check(spark, [(i, [(i % 11) / 1024.0] * 64) for i in range(80)])
    check(spark, [(i, [float(i % 2)] + [0.0] * 63) for i in range(50)])


def test_hot_vector_and_widely_spread_values(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [0.25] * 64) for i in range(60)]
    rows += [(100 + i, list(map(float, rng.normal(size=64) * 10.0 ** rng.integers(-3, 4)))) for i in range(80)]
    check(spark, rows)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(7)
    vectors = rng.integers(-500, 500, (400, 64))
    pivots = rng.integers(-500, 500, (8, 64))
    simplex = sc.Simplex(pivots)
    assert len(simplex.pivots) == 8
    a = simplex.apexes(vectors)
    true = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)
    plane = ((a[:, None, :-1] - a[None, :, :-1]) ** 2).sum(axis=2)
    low, high = (plane + (a[:, None, -1] + s * a[None, :, -1]) ** 2 for s in (-1, 1))
    assert (low <= true + 1e-3).all() and (true <= high + 1e-3).all()
    centres = pivots  # in the pivots' plane: bounds are exact and one centroid is left
    open_ = sc.possible(simplex.apexes(vectors), simplex.apexes(centres))
    assert open_.sum() <= 1.1 * len(vectors)
    cluster, best, made = sc.assigned(vectors, a, pivots, simplex.apexes(pivots))
    every = ((vectors[:, None] - pivots[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all() and made < 3 * len(vectors)


def test_flat_pivots_are_left_out():
    line = np.arange(8)[:, None] * np.ones((1, 64), np.int64) * 100
    assert len(sc.Simplex(line).pivots) == 2
    assert len(sc.Simplex(line[:1].repeat(8, axis=0)).pivots) == 1


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="not supported"):
        sc.clustered(table(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])).collect()
