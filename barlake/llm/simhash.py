"""SimHash fingerprints and near-duplicate groups by the generalised pigeonhole principle.

Equal fingerprints are one node. Bits that go together are put in one part; a part may differ by its
own threshold, where the thresholds t of m parts add up to DISTANCE - m + 1, so each pair within
DISTANCE is met in some part. Dynamic programming picks the thresholds with the lowest estimated
number of candidates: what the value counts of each part say for equal values, times the growth of
the chance of a match that the bits' frequencies give for unequal ones. Candidates are verified.

Buckets of more than BUCKET nodes are not paired. Their members, and all that probe them, meet
exactly another way: each sends its fingerprint with every bit flipped in turn; two are within two
bits exactly if they share one of these keys, and at most 65 fingerprints share a key.

Null text counts as empty; documents without words have fingerprint zero and are linked like others.
Rows with a null doc_id take part and keep it; a group of such rows alone has a null component.
Repeated rows are one group. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.components import components
from barlake.llm.scratch import find_package, numbered, over_texts, stored
from barlake.operators.lookup import attach, fits_broadcast

WORDS = 3
SEED = 42
DISTANCE = 2
BITS = 64
BUCKET = 32
#: Rows of one fingerprint above which they are not gathered by it.
CROWD = 256
#: What a signature costs, in candidates.
SIGNATURE_COST = 4.0
_BLOCK = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """Majority of the shingle hashes' bits; ASCII white space and letter case only."""
    found = text.encode().lower().split()
    if not found:
        return 0
    shingles = zip(*[found[i:] for i in range(words)], strict=False) if len(found) >= words else [found]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), SEED) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed 64-bit integer."""

    def work(ids: list, texts: list[str]) -> dict:
        return {"doc_id": ids, "bits": [fingerprint(t, words) for t in texts]}

    return over_texts(docs, work, "doc_id long, bits long")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """(number of nodes, how often each two bits are set together), added up in tasks first."""
    find_package(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, together = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = np.asarray(batch.column(0)).astype("<i8").view(np.uint8).reshape(-1, 8)
            ones = np.unpackbits(bits, axis=1, bitorder="little").astype(np.float32)
            n, together = n + len(ones), together + ones.T @ ones
        flat = np.concatenate([[n], together.ravel()]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "n"])

    cells = nodes.select("bits").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(1 + BITS * BITS, np.int64)
    for cell, n in cells.collect():  # always 1 + 64 * 64 cells
        flat[cell] = n
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def correlated_parts(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """Cut the bits into m parts of about equal size, each grown from its most correlated bits."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    linked = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(linked, 0)
    left, parts = list(range(BITS)), []
    for k in range(m):
        size = -(-len(left) // (m - k))
        part = [max(left, key=lambda b: (linked[b, left].max(), -b))]
        while len(part) < size:
            part.append(max((b for b in left if b not in part), key=lambda b: (linked[b, part].sum(), -b)))
        parts.append(sorted(part))
        left = [b for b in left if b not in part]
    return parts


def match_chances(part: list[int], share: np.ndarray, most: int) -> np.ndarray:
    """Chance that two nodes differ in at most 0 .. most of the part's bits, taken one by one."""
    differ = np.zeros(len(part) + 1)
    differ[0] = 1
    for b in part:
        p = 2 * share[b] * (1 - share[b])
        differ[1:] = differ[1:] * (1 - p) + differ[:-1] * p
        differ[0] *= 1 - p
    return np.cumsum(differ)[: most + 1]


def value_of(part: list[int], column: str = "bits"):
    """The part's bits of the fingerprint; the others are zero."""
    return F.col(column).bitwiseAND(F.lit(_signed(sum(1 << b for b in part))))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds, each from -1 on, that add up to ``total`` at the least cost: costs[i][t + 1]."""
    m = len(costs)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for spent, extra in enumerate(own):
                option = (cost + extra, [*chosen, spent - 1])
                if used + spent not in step or option < step[used + spent]:
                    step[used + spent] = option
        best = step
    return best[total + m][1]


def plan_parts(nodes: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is looked up."""
    n, together = bit_statistics(nodes)
    share = np.diag(together) / max(n, 1)
    plans = []
    for m in range(1, distance + 3):
        parts = correlated_parts(n, together, m)
        pairs = _equal_pairs(nodes, parts)
        costs = []
        for part, equal in zip(parts, pairs, strict=True):
            chances = match_chances(part, share, distance)
            own = [0.0]
            for t in range(distance + 1):
                probes = sum(comb(len(part), k) for k in range(t + 1))
                own.append(equal * chances[t] / max(chances[0], 1e-18) + SIGNATURE_COST * n * (1 + probes))
            costs.append(own)
        thresholds = allocate(costs, distance - m + 1)
        total = sum(c[t + 1] for c, t in zip(costs, thresholds, strict=True))
        plans.append((total, m, [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0]))
    return min(plans, key=lambda p: p[:2])[2]


def _equal_pairs(nodes: DataFrame, parts: list[list[int]]) -> list[float]:
    """Pairs of nodes with equal values, by part."""
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), value_of(p).alias("value")) for i, p in enumerate(parts)]))
    counted = nodes.select(values.alias("v")).groupBy("v.part", "v.value").count()
    found = dict(counted.groupBy("part").agg(F.sum(F.expr("CAST(count AS DOUBLE) * (count - 1) / 2"))).collect())
    return [float(found.get(i, 0.0)) for i in range(len(parts))]


def links(nodes: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all nodes within ``distance`` bits; ``nodes`` has unique ``bits``."""
    if distance not in (0, 1, 2):
        raise ValueError("distances of 0 to 2 bits are supported")
    if not distance:
        return nodes.select(F.col("bits").alias("a"), F.col("bits").alias("b")).where("false")
    parts = plan_parts(nodes, distance)
    own = [F.struct(F.lit(i).alias("part"), value_of(p).alias("value")) for i, (p, _) in enumerate(parts)]
    index = stored(nodes.select("bits", F.explode(F.array(*own)).alias("k")).select("bits", "k.*"), "signatures")
    masks = [
        (i, _signed(sum(1 << b for b in flipped)))
        for i, (p, t) in enumerate(parts)
        for size in range(t + 1)
        for flipped in combinations(p, size)
    ]
    probes = index
    if any(t for _, t in parts):
        flips = {i: [m for j, m in masks if j == i] for i in range(len(parts))}
        of = F.element_at(F.array(*[F.array(*map(F.lit, flips[i])) for i in range(len(parts))]), F.col("part") + 1)
        probes = index.select("bits", "part", F.explode(of).alias("mask"), "value")
        probes = probes.select("bits", "part", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    sizes = stored(index.groupBy("part", "value").count().where("count > 1"), "buckets")
    small, large = sizes.where(F.col("count") <= bucket), sizes.where(F.col("count") > bucket)
    pairs = (
        probes.join(small.select("part", "value"), ["part", "value"])
        .withColumnRenamed("bits", "a")
        .join(index.withColumnRenamed("bits", "b"), ["part", "value"])
    )
    if any(t for _, t in parts):  # buckets of one, too, are met by others' probes
        lone = index.join(sizes.select("part", "value"), ["part", "value"], "left_anti").withColumnRenamed("bits", "b")
        pairs = pairs.unionByName(probes.withColumnRenamed("bits", "a").join(lone, ["part", "value"]))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = pairs.where("a != b").where(apart <= distance).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowd = probes.join(large.select("part", "value"), ["part", "value"], "left_semi").select("bits").distinct()
    return near.unionByName(crowd_links(crowd, distance)).distinct()


def crowd_links(crowd: DataFrame, distance: int) -> DataFrame:
    """Links among nodes by shared keys: each node's bits, as they are and with one bit flipped."""
    flips = F.array(*[F.lit(_signed(m)) for m in [0, *(1 << b for b in range(BITS))]])
    keys = crowd.select("bits", F.explode(flips).alias("flip")).select(
        "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("key")
    )
    # At most 65 nodes are within one bit of a key, so the lists are short.
    met = keys.groupBy("key").agg(F.collect_list("bits").alias("met")).where(F.size("met") > 1)
    if distance == 2:
        star = met.select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
        return star.where("a != b").distinct()
    pairs = met.select("met", F.explode("met").alias("a")).select("a", F.explode("met").alias("b"))
    return pairs.where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(marked.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes, distance))
    grouped = nodes.join(roots.withColumnRenamed("node", "bits"), "bits")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = grouped.join(least, "root").select("bits", "component_id")
    of_bits = nodes.join(linked, "bits", "left").select("bits", F.coalesce("component_id", "least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    # Rows of crowded fingerprints stay where they are or are spread by salts; the others meet their node.
    crowded = stored(nodes.where(F.col("n") > CROWD).select("bits").join(of_bits, "bits"), "crowded")
    columns = ["doc_id", hexed.alias("fingerprint"), "component_id"]
    fits = fits_broadcast(crowded)
    if fits and crowded.isEmpty():
        return marked.join(of_bits, "bits").select(*columns)
    in_crowds = attach(marked, crowded, ["bits"], "inner", small_fits=fits)
    others = attach(marked, crowded.select("bits"), ["bits"], "left_anti", small_fits=fits)
    return in_crowds.select(*columns).unionByName(others.join(of_bits, "bits").select(*columns))


def without_copies(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS) -> DataFrame:
    """The documents with one row of each group: that of the smallest doc_id; null ids come last.

    Rows are told apart by a stored number, not by doc_id, so null and repeated ids lose no other text.
    """
    whole, number = numbered(docs)
    rows = whole.select(F.col(number).alias("doc_id"), "text")
    found = near_duplicates(rows, distance, words).select(F.col("doc_id").alias("row"), F.col("component_id").alias("root"))
    ids = whole.select(F.col(number).alias("row"), F.col("doc_id").alias("id"))
    of_group = stored(found.join(ids, "row"), "groups")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    kept = of_group.groupBy("root").agg(F.min_by("row", order).alias("row"))
    # One kept row each, so no row number is met twice and no group is joined by its root.
    gone = of_group.select("row").join(kept.select("row"), "row", "left_anti").withColumnRenamed("row", number)
    # Rows that go are a large part of all rows, so the plan is the same at every size: no broadcast.
    return whole.join(gone.hint("merge"), number, "left_anti").select(*docs.columns)
