"""Neighbour search and sharding against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import graph_search, sharding
from tests.llm.conftest import ODD_TEXTS
from tests.oracle import both, connect

VECTORS = "vec_id long, embedding array<float>, label int, node string, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "y") for i, v in rows], VECTORS)


def brute(rows, top=graph_search.TOP):
    want = {}
    for i, v in rows:
        if i % 20 == 0:
            order = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i)
            want[i] = [(j, -s) for s, j in order[:top]]
    return want


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_order(spark, norms, monkeypatch):
    monkeypatch.setattr(graph_search, "CHUNK", 64)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 24)).astype(np.float32)
    if norms:
        x *= rng.uniform(0.3, 2.0, (900, 1)).astype(np.float32)
    x[600:] = x[7]  # a third of all rows has one vector
    rows = [(i, v.astype(float).tolist()) for i, v in enumerate(x)]
    bad = [(None, rows[0][1]), (2000, None), (2020, [0.0] * 24), (2040, [None] + [1.0] * 23), (2060, [float("nan")] * 24),
           (2080, [float("inf")] * 24), (2100, [1.0] * 5), (2120, [])]
    doubled = rows[40]
    got = found(graph_search.nearest(table(spark, [*rows, *bad, doubled]), F.col("vec_id") % 20 == 0))
    want = brute(rows)
    assert set(got) == set(want)
    hit = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit >= 0.95 * sum(map(len, want.values()))
    exact = dict(rows)
    for q, pairs in got.items():
        assert len(pairs) == graph_search.TOP
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - float(np.dot(exact[q], exact[j]))) < 1e-9 for j, s in pairs)
    # Copies of the common vector: the smallest ids, but for the query's own.
    assert [j for j, _ in got[620]] == [7, *range(600, 619)]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(20 * i, [1.0, float(i)]) for i in range(n)]
    assert found(graph_search.nearest(table(spark, rows), F.col("vec_id") % 20 == 0)) == {
        q: pairs for q, pairs in brute(rows).items() if pairs
    }


def test_shards_match_sql(spark, small_sf):
    con = connect(small_sf)
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    for limit in (5_000, 60_000, 1 << 30):
        got, want, *_ = both(sharding.assign(docs, limit), con, sharding.oracle(limit))
        assert got == want


def check_shards(rows, limit):
    sizes = {}
    for r in rows:
        size, n = sizes.get(r["shard"], (0, 0))
        sizes[r["shard"]] = (size + r["n_bytes"], n + 1)
        assert r["depth"] == len(r["shard"])
    assert all(size <= limit or n == 1 for size, n in sizes.values())
    # Prefixes don't overlap, and each split was needed.
    for shard in sizes:
        assert not any(shard[:k] in sizes for k in range(len(shard)))
        if shard:
            below = [v for s, v in sizes.items() if s.startswith(shard[:-1])]
            assert sum(b for b, _ in below) > limit and sum(n for _, n in below) > 1


def test_hot_keys_are_split(spark):
    docs = spark.range(600).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "repeat('é', 50) AS text", "'x' AS shard")
    rows = sharding.assign(docs, 2_000).collect()
    assert len(rows) == 600 and all(r["n_bytes"] == 100 for r in rows)
    check_shards(rows, 2_000)


def test_odd_rows_are_placed(spark, docs_of, tmp_path):
    docs = docs_of([*ODD_TEXTS, (None, "no id"), (None, "no id"), (3, "again")])
    rows = sharding.assign(docs, 30).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    check_shards(rows, 30)
    assert sharding.assign(docs_of([]), 30).count() == 0
    whole = docs_of(ODD_TEXTS)
    sharding.write_shards(whole, str(tmp_path / "out"), 1_000)
    again = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"]) for r in again.where("text IS NOT NULL").collect()) == sorted(
        (i, t) for i, t in enumerate(ODD_TEXTS) if t is not None
    )
    assert again.columns[-1] == "shard_"
