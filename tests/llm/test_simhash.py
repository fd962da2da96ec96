"""Fingerprints and groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from barlake.llm import simhash
from barlake.llm.components import components
from tests.llm.conftest import ODD_TEXTS


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(bits, distance):
    order = sorted(bits)
    root = list(range(len(order)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(order, np.int64).view(np.uint64)
    for i in range(len(order)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {b: order[find(i)] for i, b in enumerate(order)}


@pytest.mark.parametrize("text", [t or "" for t in ODD_TEXTS] + ["A b\tC d e É f", "one two", "a b c a b c a b c"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    value = spark.sql("SELECT xxhash64('of the words') AS h").first()["h"]
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"of the words", 42)


def crowded(seed):
    rng = random.Random(seed)
    found = {rng.getrandbits(64) for _ in range(60)} | {0}
    for _ in range(2):
        center = rng.getrandbits(64)
        for _ in range(150):
            near = center
            for _ in range(rng.randint(0, 5)):
                near ^= 1 << rng.randrange(64)
            found.add(near)
    return [simhash._signed(f) for f in found]


@pytest.mark.parametrize(("bucket", "distance"), [(2, 2), (10_000, 2), (8, 1), (10_000, 1)])
def test_links_connect_like_brute_force(spark, bucket, distance):
    bits = crowded(bucket + distance)
    nodes = spark.createDataFrame([(b,) for b in bits], "bits long")
    got = {r["node"]: r["root"] for r in components(simhash.links(nodes, distance, bucket)).collect()}
    assert {b: got.get(b, b) for b in bits} == brute_roots(bits, distance)


@pytest.mark.parametrize("bucket", [3, 10_000])
@pytest.mark.parametrize("plan", [[(32, 1), (32, 0)], [(40, 0), (24, 1)], [(64, 2)]])
def test_unequal_thresholds_connect_like_brute_force(spark, monkeypatch, plan, bucket):
    parts, at = [], 0
    for size, t in plan:
        parts.append((list(range(at, at + size)), t))
        at += size
    monkeypatch.setattr(simhash, "plan_parts", lambda nodes, distance: parts)
    bits = crowded(7)[:90] if plan[0][1] == 2 else crowded(7)
    nodes = spark.createDataFrame([(b,) for b in bits], "bits long")
    got = {r["node"]: r["root"] for r in components(simhash.links(nodes, 2, bucket)).collect()}
    assert {b: got.get(b, b) for b in bits} == brute_roots(bits, 2)


def test_allocation_is_the_cheapest():
    assert simhash.allocate([[0, 5, 9, 99], [0, 1, 2, 3], [0, 50, 60, 70]], 0) == [-1, 2, -1]
    assert simhash.allocate([[0, 1, 90, 99], [0, 1, 90, 99], [0, 1, 90, 99]], 0) == [0, 0, 0]


def test_groups_of_documents(spark, documents):
    rows = simhash.near_duplicates(documents).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    marks = {i: simhash._signed(brute_fingerprint(t)) for i, t in texts.items()}
    roots = brute_roots(set(marks.values()), 2)
    least = {}
    for i, m in marks.items():
        least[roots[m]] = min(i, least.get(roots[m], i))
    assert len(rows) == len(texts)
    for r in rows:
        assert r["fingerprint"] == f"{marks[r['doc_id']] % (1 << 64):016x}"
        assert r["component_id"] == least[roots[marks[r["doc_id"]]]]


def test_odd_documents(spark, docs_of):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(ODD_TEXTS)).collect()}
    assert len(rows) == len(ODD_TEXTS)
    assert rows[0]["fingerprint"] == "0" * 16 and rows[0]["component_id"] == rows[3]["component_id"] == 0
    assert rows[9]["component_id"] == 8
    assert simhash.near_duplicates(docs_of([])).count() == 0
    same = simhash.near_duplicates(docs_of([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "other words")]))
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in same.collect()) == [(-1, -1), (-1, 5), (5, 5), (5, 5)]


def test_one_of_each_group_stays(spark, docs_of):
    docs = docs_of([(4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "quite another text"), (None, "a b c d"),
                    (None, "no id"), (None, "no id"), (None, "none either"), (9, "a text of the same id"), (None, None)])
    kept = simhash.without_copies(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or -1), r["text"] or "") for r in kept.collect())
    want = [(-1, ""), (-1, "no id"), (-1, "none either"), (2, "a b c d"), (9, "a text of the same id"), (9, "quite another text")]
    assert got == want
    assert simhash.without_copies(docs_of([])).count() == 0


def test_crowded_fingerprints_are_not_gathered(spark, docs_of, monkeypatch):
    texts = ["the same copy of one text"] * 40 + [f"text {i} of its own kind and words {i * 7}" for i in range(30)]
    texts += ["another copy that is here often"] * 30 + [None] * 20
    expected = sorted(tuple(r) for r in simhash.near_duplicates(docs_of(texts)).collect())
    monkeypatch.setattr(simhash, "CROWD", 8)
    assert sorted(tuple(r) for r in simhash.near_duplicates(docs_of(texts)).collect()) == expected
    monkeypatch.setattr(simhash, "fits_broadcast", lambda df: False)
    assert sorted(tuple(r) for r in simhash.near_duplicates(docs_of(texts)).collect()) == expected


def test_long_chains(spark):
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.sql("SELECT 5L AS a, 5L AS b"))
    chain = chain.unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS a, 7L AS b")).unionByName(spark.sql("SELECT 900L AS a, 800L AS b"))
    got = {r["node"]: r["root"] for r in components(chain).collect()}
    assert got == {i: 0 for i in range(301)} | {800: 800, 900: 800}
