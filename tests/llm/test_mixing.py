"""Sources mixed to their targets: against DuckDB, and against plain water filling."""

from collections import defaultdict
from fractions import Fraction

import pytest

from barlake.llm import mixing
from barlake.llm.queries import ORACLE_SQL, REGISTRY
from tests.llm.conftest import DOCS, ODD_TEXTS
from tests.oracle import both, connect


def filled(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    """Targets by resharing the excess until none is above; ``sizes`` by source, a null source last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, rest = list(order), {}, share * sum(sizes.values())
    while left:
        level = rest / sum(weight[s] for s in left)
        full = [s for s in left if most * sizes[s] <= level * weight[s]]
        if not full:
            return out | {s: level * weight[s] for s in left}
        for s in full:
            out[s] = Fraction(most * sizes[s])
            rest -= out[s]
            left.remove(s)
    return out


def with_sources(spark, rows):
    return spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)


def test_query_against_sql(spark, oracle_sf):
    got, want, names, sql_names = both(REGISTRY["op11_source_mix"](spark, oracle_sf), connect(oracle_sf), ORACLE_SQL["op11_source_mix"])
    assert names == sql_names and got == want and len(got) == 1000


@pytest.mark.parametrize("ranges", [2, 100_000])
def test_targets_against_water_filling(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE", ranges)
    sizes = {"a": 10, "b": 900, "B": 3, "é": 55, "zz": 0, None: 700, "漢": 1, "n": 40, "": 8, "v": 2000}
    rows = [(k, " ".join(["w"] * n) if n else None, s) for k, (s, n) in enumerate(sizes.items())]
    planned = mixing.plan_mix(with_sources(spark, rows * 3)).select("doc.source", "source_size", "target", "copies", "size").collect()
    want = filled({s: 3 * n for s, n in sizes.items()})
    for r in planned:
        assert r["source_size"] == 3 * sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-15)
        assert 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
    assert sum(want.values()) == Fraction(3, 2) * 3 * sum(sizes.values())


def test_words_come_near_targets_and_reruns_agree(spark, oracle_sf):
    docs = spark.read.parquet(f"{oracle_sf}/documents.parquet")
    first = sorted(mixing.taken_digest(docs).collect())
    assert first == sorted(mixing.taken_digest(docs.repartition(13)).collect())
    crowd = spark.range(20_000).selectExpr("id AS doc_id", "repeat('word ', 1 + int(id % 9)) AS text", "if(id % 3 = 0, 'a', if(id % 3 = 1, 'b', null)) AS source")
    taken, target = defaultdict(int), {}
    for r in mixing.taken_digest(crowd).collect():
        taken[r["doc_id"] % 3] += r["taken"]
        target[r["doc_id"] % 3] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for k, t in target.items():
        assert taken[k] == pytest.approx(t, rel=0.03)


def test_rows_alike_have_chances_of_their_own(spark):
    rows = [(None, "one two three", "a")] * 3000 + [(5, "one two three", "a")] * 500 + [(6, "four", "b"), (None, None, None), (6, "four", "b")]
    docs = with_sources(spark, rows)
    planned = mixing.taken_digest(docs.repartition(7))
    found = sorted(tuple(x if x is not None else -1 for x in r) for r in planned.collect())
    assert len(found) == len(rows)
    taken = sum(r[4] for r in found if r[1] == 3)
    assert taken == pytest.approx(1.5 * 3 * 3500, rel=0.05)
    assert found == sorted(tuple(x if x is not None else -1 for x in r) for r in mixing.taken_digest(docs).collect())


def test_the_mix_itself(spark, docs_of):
    docs = docs_of(["a b c", "d e", None, "", "f"])
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs).select("doc.doc_id", "copies").collect()}
    emitted = mixing.mixed(docs)
    assert emitted.columns == docs.columns
    got = defaultdict(int)
    for r in emitted.collect():
        got[r["doc_id"]] += 1
    assert dict(got) == {i: c for i, c in copies.items() if c} and got


def test_odd_rows(spark, docs_of):
    docs = docs_of(ODD_TEXTS)
    words = lambda t: len((t or "").encode().split())
    rows = {r["doc_id"]: r for r in mixing.taken_digest(docs).collect()}
    assert {i: rows[i]["size"] for i in rows} == {i: words(t) for i, t in enumerate(ODD_TEXTS)}
    assert {r["target"] for r in rows.values()} == {1.5 * sum(map(words, ODD_TEXTS))}
    assert mixing.taken_digest(docs_of([])).count() == 0
    nothing = mixing.taken_digest(docs_of([None, "", " "])).collect()
    assert [(r["target"], r["taken"]) for r in nothing] == [(0.0, 0)] * 3


def test_no_python_workers_in_the_plan(spark, oracle_sf):
    plan = REGISTRY["op11_source_mix"](spark, oracle_sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
