"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search on it.

Vectors get one more component that makes their norms equal, so that neighbours by inner product are
neighbours by distance. Equal vectors are one node. The graph starts from chunks of CHUNK vectors in
the order of random projections (a chunk has that size whatever is common), and improves by joins:
each node's neighbours and the nodes that have it as neighbour are joined to their vectors and
compared with each other, as a neighbour's neighbour is likely a neighbour; each comparison with a
new neighbour that beats a list's last entry goes to that list. A query walks the graph: it expands
its BEAM best nodes that are not yet expanded, keeps the POOL best it has met, and ends when all of
these are expanded. Every vector is in the index. The nodes found are scored again in double
precision on the original vectors, all of the POOL.

Take no part: null ids; null, empty or zero vectors; vectors with null or non-finite components; and
those not of the table's commonest length. Repeated ids count once, with the smallest of their
vectors. A query is no candidate of its own. Ties go to the smaller vec_id. With few candidates all
are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.scratch import arrow_schema, find_package, stored

NEIGHBOURS = 24
SAMPLE = 14
BACK = 16
CHUNK = 4096
STARTS = 8
ROUNDS = 3
POOL = 320
BEAM = 64
ENTRIES = 8
TOP = 20
LIST_ROW = "node long, ids array<long>, sims array<float>, fresh array<boolean>"


def usable(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector): the rows that take part; vectors as arrays of doubles."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND size(vector) > 0").where(~odd).where(F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    # Zeros of either sign are the same number.
    plain = F.transform("vector", lambda x: F.when(x == 0, 0.0).otherwise(x))
    same = rows.where(F.size("vector") == (common["n"] if common else 0)).select("vec_id", plain.alias("vector"))
    return same.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nodes_of(rows: DataFrame, ids_kept: int) -> DataFrame:
    """(node, members, vector): one node per vector, with its ``ids_kept`` smallest ids.

    Ids are kept in parts first, as one vector may have a third of all ids.
    """
    parts = max(16, rows.count() // 100_000)
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    least = lambda ids: F.slice(F.array_sort(ids), 1, ids_kept)
    some = rows.groupBy("vector", part.alias("part")).agg(least(F.collect_list("vec_id")).alias("ids"))
    whole = some.groupBy("vector").agg(least(F.flatten(F.collect_list("ids"))).alias("members"))
    return whole.select(F.element_at("members", 1).alias("node"), "members", "vector")


def packed(nodes: DataFrame) -> DataFrame:
    """(node, half): the vector over the largest norm, and what its evening component lacks to 1, as 32-bit floats.

    That is kept, not the component, so that small vectors beside a large one lose no digits.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    largest = nodes.agg(F.max(square)).first()[0] or 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1)) / np.sqrt(largest)
            square = (x * x).sum(axis=1, keepdims=True)
            lack = square / (1 + np.sqrt(np.maximum(0, 1 - square)))
            half = np.concatenate([x, lack], axis=1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.tobytes() for h in half])], names=["node", "half"])

    return nodes.select("node", "vector").mapInArrow(run, "node long, half binary")


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def halves(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float32).reshape(len(column), -1)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of evened vectors, less 1."""
    a, b = x[:, -1:], y[:, -1]
    return x[:, :-1] @ y[:, :-1].T - (a + b - a * b)


def list_rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def chunk_lists(vectors: DataFrame, seed: int) -> DataFrame:
    """Each node's best neighbours within its chunk, in the order of one random projection."""
    find_package(vectors.sparkSession)
    target = arrow_schema(vectors.sparkSession, LIST_ROW)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if batch.num_rows:
                x = halves(batch.column(1))
                if planes is None:
                    planes = np.random.default_rng(seed).standard_normal((x.shape[1], 9)).astype(np.float32)
                y = x @ planes
                cell = (y[:, :8] > 0) @ (1 << np.arange(8))
                order = pa.array(cell * 1000.0 + y[:, 8], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), order], names=["node", "half", "o"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches):
            k = min(NEIGHBOURS, len(ids) - 1)
            for at in range(0, len(ids) if k else 0, 512):
                sims = likeness(x[at : at + 512], x)
                rows = np.arange(len(sims))
                sims[rows, at + rows] = -np.inf
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(sims, best, axis=1)
                yield list_rows(target, ids[at : at + 512], list(ids[best]), list(value), [np.ones(k, bool)] * len(sims))

    ordered = vectors.mapInArrow(project, "node long, half binary, o double").repartitionByRange("o")
    return ordered.sortWithinPartitions("o").mapInArrow(compare, LIST_ROW)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of CHUNK rows of a sorted partition; a short rest joins the run before."""
    ids, x = np.empty(0, np.int64), None
    for batch in batches:
        ids = np.concatenate([ids, np.asarray(batch.column(0))])
        x = halves(batch.column(1)) if x is None or not len(x) else np.concatenate([x, halves(batch.column(1))])
        while len(ids) >= 2 * CHUNK:
            yield ids[:CHUNK], x[:CHUNK]
            ids, x = ids[CHUNK:], x[CHUNK:]
    if len(ids):
        yield ids, x


def merged(lists: DataFrame) -> DataFrame:
    """One list per node: the best of all its lists, each neighbour once; old entries stay old."""
    find_package(lists.sparkSession)
    target = arrow_schema(lists.sparkSession, LIST_ROW)
    gathered = lists.groupBy("node").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("ids", "sims", "fresh")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for i in range(batch.num_rows):
                ids, sims, fresh = (np.asarray(batch.column(c)[i].values) for c in (1, 2, 3))
                order = np.lexsort((ids, fresh, -sims))
                keep = order[np.sort(np.unique(ids[order], return_index=True)[1])][:NEIGHBOURS]
                known = set(ids[~fresh].tolist())
                out[0].append(ids[keep])
                out[1].append(sims[keep])
                out[2].append([j not in known for j in ids[keep].tolist()])
            yield list_rows(target, batch.column(0), *out)

    return gathered.mapInArrow(run, LIST_ROW)


def back_links(graph: DataFrame, most: int, salt: int) -> DataFrame:
    """(node, back): some of the nodes that have it in their lists, picked by hash, in parts first."""
    edges = graph.select(F.explode("ids").alias("at"), F.col("node").alias("by"))
    pick = F.struct(F.xxhash64("by", F.lit(salt)).alias("h"), F.col("by").alias("id"))
    some = lambda c: F.slice(F.array_sort(c), 1, most)
    parts = edges.groupBy("at", F.pmod(F.xxhash64("by"), F.lit(16)).alias("p")).agg(some(F.collect_list(pick)).alias("l"))
    whole = parts.groupBy("at").agg(some(F.flatten(F.collect_list("l"))).alias("l"))
    return whole.select(F.col("at").alias("node"), F.col("l.id").alias("back"))


def descend(graph: DataFrame, vectors: DataFrame, salt: int) -> DataFrame:
    """One round: the members of each neighbourhood are compared with each other."""
    find_package(graph.sparkSession)
    target = arrow_schema(graph.sparkSession, LIST_ROW)
    entry = F.arrays_zip("ids", "fresh")
    # New entries first, picked by hash among equals.
    picked = F.slice(
        F.array_sort(F.transform(entry, lambda e: F.struct((~e["fresh"]).alias("old"), F.xxhash64(e["ids"], F.lit(salt)).alias("h"), e["ids"].alias("id")))),
        1, SAMPLE,
    )
    ahead = graph.select("node", picked.alias("p"))
    chosen = ahead.select("node", F.explode("p").alias("e")).select("node", F.col("e.id").alias("id"), (~F.col("e.old")).alias("new"))
    back = back_links(graph, SAMPLE, salt).select("node", F.explode("back").alias("id")).withColumn("new", F.lit(True))
    own = graph.select("node", F.col("node").alias("id"), F.lit(False).alias("new"))
    members = chosen.unionByName(back).unionByName(own).groupBy("node", "id").agg(F.max("new").alias("new"))
    last = graph.select(F.col("node").alias("id"), F.when(F.size("sims") >= NEIGHBOURS, F.array_min("sims")).otherwise(-3.0).alias("last"))
    full = vectors.withColumnRenamed("node", "id").join(last, "id", "left").fillna(-3.0, ["last"])
    rows = members.join(full, "id").groupBy("node").agg(F.collect_list(F.struct("id", "new", "last", "half")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i in range(batch.num_rows):
                m = batch.column(0)[i].values
                ids, new, least = (np.asarray(m.field(c)) for c in range(3))
                x = halves(m.field(3))
                sims = likeness(x, x)
                good = (new[:, None] | new[None, :]) & (sims > least[:, None])
                np.fill_diagonal(good, False)
                a, b = np.nonzero(good)
                found.append((ids[a], ids[b], sims[a, b]))
            if not found:
                continue
            to, ids, sims = (np.concatenate(c) for c in zip(*found, strict=True))
            if not len(to):
                continue
            # Each list gets its best proposals of this batch once, in one row.
            order = np.lexsort((-sims, to))
            to, ids, sims = to[order], ids[order], sims[order]
            _, first = np.unique(np.stack([to, ids]), axis=1, return_index=True)
            first.sort()
            to, ids, sims = to[first], ids[first], sims[first]
            cut = np.flatnonzero(np.concatenate([[True], np.diff(to) != 0]))
            ends = [*cut[1:].tolist(), len(to)]
            spans = [(a, min(b, a + NEIGHBOURS)) for a, b in zip(cut.tolist(), ends, strict=True)]
            yield list_rows(
                target, to[cut], [ids[a:b] for a, b in spans], [sims[a:b] for a, b in spans],
                [np.ones(b - a, bool) for a, b in spans],
            )

    proposed = rows.select("m").mapInArrow(run, LIST_ROW)
    # What took part as new is old from now on.
    taken = F.transform(F.slice("p", 1, SAMPLE), lambda e: e["id"])
    fresh = F.transform(entry, lambda e: e["fresh"] & ~F.array_contains(F.col("taken"), e["ids"]))
    aged = graph.join(ahead.select("node", taken.alias("taken")), "node").select("node", "ids", "sims", fresh.alias("fresh"))
    return merged(aged.unionByName(proposed))


def build_graph(vectors: DataFrame) -> DataFrame:
    starts = [chunk_lists(vectors, seed) for seed in range(STARTS)]
    graph = stored(merged(reduce(DataFrame.unionByName, starts)), "graph")
    for k in range(ROUNDS):
        graph = stored(descend(graph, vectors, k), "graph")
    return graph


def neighbourhoods(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """(node, ids, block): each node's neighbours both ways, with their vectors in a row."""
    both = graph.join(back_links(graph, BACK, -1), "node", "left")
    ids = F.array_union("ids", F.coalesce("back", F.array().cast("array<long>")))
    edges = both.select("node", F.explode(ids).alias("id"))
    joined = edges.join(vectors.withColumnRenamed("node", "id"), "id")
    rows = joined.groupBy("node").agg(F.collect_list(F.struct("id", "half")).alias("m"))
    return rows.select("node", F.col("m.id").alias("ids"), F.col("m.half").alias("blocks"))


STATE = "query_id long, q binary, ids array<long>, sims array<float>, done array<boolean>, next array<long>"


def search(queries: DataFrame, graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, ids, sims): the POOL best nodes each query meets; ``queries``: query_id, q, entries.

    ``q`` is packed like the nodes, but for its last component, which is 0.
    """
    spark = queries.sparkSession
    find_package(spark)
    target, scored = arrow_schema(spark, STATE), "query_id long, ids array<long>, sims array<float>"
    scored_schema = arrow_schema(spark, scored)
    near = stored(neighbourhoods(graph, vectors), "neighbourhoods")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_out, sims_out = [], []
            for i in range(batch.num_rows):
                q = np.frombuffer(batch.column(1)[i].as_py(), np.float32)
                sims = halves(batch.column(4)[i].values) @ q
                better = sims > batch.column(2)[i].as_py()
                ids_out.append(np.asarray(batch.column(3)[i].values)[better])
                sims_out.append(sims[better])
            yield list_rows(scored_schema, batch.column(0), ids_out, sims_out)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for row in batch.to_pylist():
                ids = np.array(row["ids"] + (row["new_ids"] or []), np.int64)
                sims = np.array(row["sims"] + (row["new_sims"] or []), np.float32)
                expanded = set(row["next"]) | {i for i, d in zip(row["ids"], row["done"], strict=True) if d}
                order = np.lexsort((ids, -sims))
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])][:POOL]
                ids, sims = ids[order], sims[order]
                done = [i in expanded for i in ids.tolist()]
                out[0].append(ids)
                out[1].append(sims)
                out[2].append(done)
                out[3].append([i for i, d in zip(ids.tolist(), done, strict=True) if not d][:BEAM])
            yield list_rows(target, batch.column(0), batch.column(1), *out)

    none = F.array()
    state = stored(
        queries.select(
            "query_id", "q", none.cast("array<long>").alias("ids"), none.cast("array<float>").alias("sims"),
            none.cast("array<boolean>").alias("done"), F.col("entries").alias("next"),
        ), "search",
    )
    while True:
        going = state.where("size(next) > 0")
        if going.isEmpty():
            return state.select("query_id", "ids", "sims")
        floor = F.when(F.size("sims") >= POOL, F.array_min("sims")).otherwise(F.lit(-2.0)).cast("float")
        steps = going.select("query_id", "q", floor.alias("floor"), F.explode("next").alias("node"))
        met = steps.join(near, "node").select("query_id", "q", "floor", "ids", "blocks").mapInArrow(score, scored)
        new = met.groupBy("query_id").agg(
            F.flatten(F.collect_list("ids")).alias("new_ids"), F.flatten(F.collect_list("sims")).alias("new_sims")
        )
        state = stored(state.join(new, "query_id", "left").mapInArrow(keep, STATE), "search")


def nearest(table: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of every row for which ``is_query`` holds."""
    find_package(table.sparkSession)
    rows = stored(usable(table), "vectors")
    nodes = stored(nodes_of(rows, top + 1), "nodes")
    vectors = stored(packed(nodes), "packed")
    graph = build_graph(vectors)
    wanted = rows.where(is_query)
    # Every query starts at its own node and at a few that are the same for all.
    entries = [r["node"] for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()]
    own = wanted.join(nodes, "vector").select(F.col("vec_id").alias("query_id"), "node")
    start = F.array_distinct(F.concat(F.array("node"), F.array(*map(F.lit, entries)).cast("array<long>")))
    queries = own.join(vectors, "node").select("query_id", flat(F.col("half")).alias("q"), "node", start.alias("entries"))
    found = search(queries, graph, vectors)
    pairs = found.select("query_id", F.explode("ids").alias("node"))
    pairs = pairs.unionByName(queries.select("query_id", "node")).distinct()  # copies of the query's own vector
    exact = (
        pairs.join(nodes, "node")
        .join(wanted.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q")), "query_id")
        .withColumn("score", F.aggregate(F.zip_with("vector", "q", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
        .select("query_id", "score", F.explode("members").alias("vec_id"))
        .where("vec_id != query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def flat(half: Column) -> Column:
    """The packed vector with its last component set to 0."""
    return F.concat(F.expr("substring(half, 1, length(half) - 4)"), F.lit(b"\0\0\0\0"))
