"""K-means over whole numbers, with centroids ruled out by n-simplex projection.

A vector's exact distances to a few pivots are taken once and turned into apex coordinates: its place in
the pivots' simplex (from the distances alone, by forward substitution) and its altitude above it. For a
vector and a centroid the distance of the apexes is a lower bound of the true distance, and the one with
one altitude turned over an upper bound. A centroid whose lower bound is above another's upper bound is
not nearest; the others are compared in exact whole numbers, so results never depend on the bounds.

The bounds are exact where centroids lie in the pivots' plane and loosen as they leave it. So the
coordinates are cached as a table, and taken anew from the centroids of the round, at most REFRESHES
times, when more than half of the comparisons passed the bounds.

Vectors count that have exactly DIMENSIONS components, none of them null or not finite; other rows are not
returned. Null ids are hashed after all others; repeated ids and vectors are vectors of their own, ties
of hashes go by the vector. With fewer vectors than CLUSTERS there are as many centroids as vectors; an
empty table gives no rows. Whole components beyond LARGEST are refused, as squares would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import arrow_schema, find_package, stored

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
REFRESHES = 4
LARGEST = 1 << 27
#: A pivot this near the plane of the others, as a share of the widest distance, is left out.
FLAT = 1e-3
#: Room for rounding of cached coordinates, as a share of the squared distances involved.
SLACK = 1e-5


def whole_vectors(table: DataFrame, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(vec_id, v) of the rows that take part, in whole numbers."""
    x = F.col(vector).cast("array<double>")
    fine = (F.size(x) == DIMENSIONS) & F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    small = F.forall("v", lambda c: F.abs(c) <= LARGEST)
    refused = F.raise_error(F.lit(f"components of more than {LARGEST} / {SCALE} are not supported")).cast("array<int>")
    whole = table.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v")
    )
    return whole.select("vec_id", F.when(small, F.col("v").cast("array<int>")).otherwise(refused).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; ``clusters`` rows come to the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), DIMENSIONS)


def squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


class Simplex:
    """Apex coordinates over pivots; those that add no altitude are left out."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[:1]
        rows: list[np.ndarray] = []
        widest = max((int(squares(pivots, p).max()) for p in pivots), default=0)
        for p in pivots[1:]:
            self.lower = np.array([[*r, *[0.0] * (len(rows) - len(r))] for r in rows]).reshape(len(rows), len(rows))
            place = self.apexes(p[None])[0]
            if place[-1] > FLAT * widest**0.5:
                rows.append(place)
                self.pivots = np.concatenate([self.pivots, p[None]])
        self.lower = np.array([[*r, *[0.0] * (len(rows) - len(r))] for r in rows]).reshape(len(rows), len(rows))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' plane, and the altitude last, from distances to the pivots."""
        first = squares(vectors, self.pivots[0]).astype(np.float64)
        out = np.zeros((len(vectors), len(self.pivots)))
        for i, p in enumerate(self.pivots[1:]):
            row = self.lower[i]
            cosine = (first - squares(vectors, p) + row @ row) / 2
            out[:, i] = (cosine - out[:, :i] @ row[:i]) / row[i]
        out[:, -1] = np.sqrt(np.maximum(first - np.einsum("ij,ij->i", out[:, :-1], out[:, :-1]), 0))
        return out


def possible(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroids may be the nearest of each vector."""
    plane = ((apexes[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    high, low = apexes[:, None, -1], centres[None, :, -1]
    slack = SLACK * ((apexes**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None]) + 1
    upper = (plane + (high + low) ** 2 + slack).min(axis=1)
    return plane + (high - low) ** 2 - slack <= upper[:, None]


def assigned(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, comparisons made): exactly the nearest, ties to the smaller number."""
    open_ = possible(apexes, centres)
    cluster, best = np.zeros(len(vectors), np.int32), np.full(len(vectors), np.iinfo(np.int64).max)
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, j])
        distance = squares(vectors[rows], centroid)
        nearer = distance < best[rows]
        best[rows[nearer]], cluster[rows[nearer]] = distance[nearer], j
    return cluster, best, int(open_.sum())


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def cached(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """(vec_id, v, apex), written down; coordinates in single precision."""
    schema = "vec_id long, v array<int>, apex array<float>"
    target = arrow_schema(vectors.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = simplex.apexes(_matrix(batch.column(1), np.int64)).astype(np.float32)
                ends = pa.array(np.arange(0, apexes.size + 1, apexes.shape[1]), pa.int32())
                column = pa.ListArray.from_arrays(ends, pa.array(apexes.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(target[1].type), column], schema=target)

    return stored(vectors.select("vec_id", "v").mapInArrow(run, schema), "apexes")


def round_sums(table: DataFrame, simplex: Simplex, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Of each cluster: vectors, comparisons made, and the exact sums of components. Tasks add up first."""
    centres, k = simplex.apexes(centroids), len(centroids)
    schema = "cluster int, n long, compared long, sums array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, compared, sums = np.zeros(k, np.int64), 0, np.zeros((k, centroids.shape[1]), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), np.int64)
                cluster, _, made = assigned(vectors, _matrix(batch.column(1), np.float64), centroids, centres)
                n, compared = n + np.bincount(cluster, minlength=k), compared + made
                for j in np.unique(cluster):
                    sums[j] += vectors[cluster == j].sum(axis=0)
        share = [compared, *[0] * (k - 1)]
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(range(k), pa.int32()), "n": n, "compared": share, "sums": list(sums)})

    wide = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    added = table.select("v", "apex").mapInArrow(run, schema).groupBy("cluster")
    rows = added.agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), *wide).collect()  # one for each cluster
    return {r["cluster"]: (r["n"], r["compared"], [int(x) for x in r[3:]]) for r in rows}


def clustered(table: DataFrame, vector: str = "embedding", id_column: str = "vec_id", clusters: int = CLUSTERS,
              rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    find_package(table.sparkSession)
    vectors = whole_vectors(table, vector, id_column)
    centroids = first_centroids(vectors, clusters, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return vectors.where("false").selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        )
    simplex, refreshed = Simplex(centroids), 0
    points = cached(vectors, simplex)
    for _ in range(rounds):
        sums = round_sums(points, simplex, centroids)
        new = [[s // n for s in total] if n else list(c) for (n, _, total), c in ((sums[j], c) for j, c in enumerate(centroids.tolist()))]
        centroids = np.array(new, np.int64)
        passed, most = sum(s[1] for s in sums.values()), sum(s[0] for s in sums.values()) * len(centroids)
        if 2 * passed > most and refreshed < REFRESHES:
            simplex, refreshed = Simplex(centroids), refreshed + 1
            points = cached(points, simplex)
    centres = simplex.apexes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = assigned(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float64), centroids, centres)
                yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "cluster": cluster, "distance": distance})

    found = stored(points.select("vec_id", "v", "apex").mapInArrow(run, schema), "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("inertia")
    own = dict(found.groupBy("cluster").agg(wide).collect())  # one for each cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = F.array(*[
        F.struct(F.lit(own.get(j, 0)).cast("long").alias("inertia"), F.lit(d).alias("digest")) for j, d in enumerate(digests)
    ])
    fact = F.get(facts, F.col("cluster"))
    return found.select("vec_id", "cluster", "distance", fact["inertia"].alias("cluster_inertia"),
                        F.lit(sum(own.values())).cast("long").alias("inertia"), fact["digest"].alias("centroid_sha256"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same for DuckDB, every vector against every centroid in every round."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS place, * FROM (
    SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS})
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS j, v
  FROM (SELECT v, sha256('{seed}:' || vec_id) AS h FROM kept ORDER BY h NULLS LAST, v LIMIT {clusters})
)"""]  # fmt: skip
    apart = "CAST(list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) for i in range(1, len(k.v) + 1)]) AS BIGINT)"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT k.place, min({{'d': {apart}, 'j': c.j}}) AS best FROM kept k, c{r} c GROUP BY k.place
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT j, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT a.best.j AS j, unnest(k.v) AS x, generate_subscripts(k.v, 1) AS i FROM kept k JOIN a{r} a USING (place))
      GROUP BY j, i) GROUP BY j) n ON n.j = c.j
)""")
    return f"""WITH {", ".join(steps)}
SELECT k.vec_id, a.best.j AS cluster, a.best.d AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept k JOIN a{rounds} a USING (place) JOIN c{rounds} c ON c.j = a.best.j
"""
