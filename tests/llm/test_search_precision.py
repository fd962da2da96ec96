"""Recall where one vector is much longer than the others, and among near copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import graph_search
from tests.llm.test_search_shards import brute, found, table


@pytest.mark.parametrize("kind", ["long", "near"])
def test_skewed_vectors(spark, kind, monkeypatch):
    monkeypatch.setattr(graph_search, "CHUNK", 128)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 24))
    if kind == "long":
        x[300] *= 1e5
    else:
        x[400:] = x[7] * (1 + 1e-4 * rng.standard_normal((200, 24)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(graph_search.nearest(table(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows)
    hit = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit >= 0.95 * sum(map(len, want.values()))
