"""Exact k-means over whole numbers, with distance bounds that spare most vectors a scan of all centroids."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.store import alternating, save

#: Components are multiplied by this and rounded down.
SCALE = 256

#: Bounds are loosened by this share of themselves, many times the rounding error of a double.
SLACK = 1e-9


def largest_component(width: int) -> int:
    """The largest whole number whose squared distances over ``width`` components fit in a long."""
    return math.isqrt((2**63 - 1) // width) // 2


def kept(vector: Column, width: int) -> Column:
    """Exactly ``width`` components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def scaled(vectors: DataFrame, key: str, vector: str, width: int) -> DataFrame:
    """``key, v``: the kept vectors in whole numbers. A number whose squared distances may not fit in a long is an error."""
    most = largest_component(width)
    number = lambda x: F.floor(SCALE * x.cast("double"))
    checked = lambda x: F.when(F.abs(x.cast("double")) * SCALE < most, number(x)).otherwise(
        F.raise_error(F.lit(f"a component times {SCALE} exceeds {most}")).cast("long")
    )
    v = F.transform(F.col(vector), lambda x: checked(x).cast("int"))
    return vectors.where(kept(F.col(vector), width)).select(F.col(key).alias("key"), v.alias("v"))


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every centroid, all in whole numbers."""
    reach = int(max(abs(x).max(initial=0), abs(centroids).max(initial=0)))
    if 4 * reach * reach * x.shape[1] < 2**53:  # every sum is a whole number that a double holds
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        out = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)
        return out.astype(np.int64)
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for j, c in enumerate(centroids.astype(np.int64)):
        out[:, j] = ((x.astype(np.int64) - c) ** 2).sum(axis=1)
    return out


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How much closer any other centroid may have come to any vector of each cluster.

    The vectors of cluster i lie in the sphere around ``old[i]`` of ``radius[i]``. Let centroid j move by d from c to c'. The difference
    |x - c| - |x - c'| is the integral of the cosine of the angle between the path and the line to x; that
    angle grows along the path, so the difference is at most d times the cosine at the start. In the plane of ``old[i]``, c and c' the sphere
    lies at an angle a from the path as seen from c and spans an angle b to both sides, with sin b = radius / distance: no
    vector in it sees less than a - b. So the bound loses d cos(max(0, a - b)): less than the full drift d, and nothing, or
    even less, where c moves sideways or away. It loses d where c lies in the sphere. Of all j the greatest counts.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    path = new - old
    drift = np.linalg.norm(path, axis=1)
    out = np.full(len(old), -np.inf)
    for i in range(len(old)):
        to = old[i] - old
        distance = np.linalg.norm(to, axis=1)
        outside = (distance > radius[i]) & (drift > 0)
        loses = drift.copy()
        d, r = distance[outside], radius[i]
        cos_a = np.clip((to[outside] * path[outside]).sum(axis=1) / (d * drift[outside]), -1, 1)
        sin_a, sin_b = np.sqrt(1 - cos_a**2), r / d
        cos_b = np.sqrt(1 - sin_b**2)
        tight = np.where(cos_a >= cos_b, 1.0, cos_a * cos_b + sin_a * sin_b)
        loses[outside] = drift[outside] * np.minimum(1.0, tight + SLACK)
        loses[i] = -np.inf
        out[i] = loses.max(initial=-np.inf)
    return out


def assign(x, cluster, lower, centroids, loses):
    """New ``cluster, distance, lower`` and whether each row was scanned.

    ``lower`` bounds the distance to every centroid but the own from below. After it is loosened, a vector closer than it to its own moved
    centroid stays; any other is compared with all centroids.
    """
    if loses is None:
        lower, distance = np.full(len(x), -np.inf), np.zeros(len(x), dtype=np.int64)
    else:
        fall = loses[cluster]
        lower = lower - np.where(fall > 0, fall * (1 + SLACK), np.where(fall > -np.inf, fall * (1 - SLACK), 0))
        distance = np.empty(len(x), dtype=np.int64)
        for i in np.unique(cluster).tolist():
            rows = np.flatnonzero(cluster == i)
            distance[rows] = squared_distances(x[rows], centroids[i : i + 1])[:, 0]
    doubtful = ~(np.sqrt(distance.astype(np.float64)) * (1 + SLACK) < lower * (1 - SLACK))
    rows = np.flatnonzero(doubtful)
    cluster, distance, lower = cluster.copy(), distance, lower.copy()
    if len(rows):
        all_of = squared_distances(x[rows], centroids)
        own = all_of.argmin(axis=1)  # the first of equals: the smaller number
        cluster[rows], distance[rows] = own, all_of[np.arange(len(rows)), own]
        if len(centroids) > 1:
            all_of[np.arange(len(rows)), own] = np.iinfo(np.int64).max
            lower[rows] = np.sqrt(all_of.min(axis=1).astype(np.float64)) * (1 - SLACK)
        else:
            lower[rows] = np.inf
    return cluster, distance, lower, doubtful


def _assigned(state: DataFrame, centroids: np.ndarray, loses) -> DataFrame:
    width = centroids.shape[1]

    def assigning(batches):
        for batch in batches:
            x = np.asarray(batch.column("v").flatten()).reshape(-1, width)
            cluster, lower, scans = (np.asarray(batch.column(c)) for c in ("cluster", "lower", "scans"))
            cluster, distance, lower, scanned = assign(x, cluster, lower, centroids, loses)
            columns = [pa.array(c) for c in (cluster, distance, lower, scans + scanned.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=batch.schema.names)

    return state.mapInArrow(assigning, state.schema)


def _component_sums(state: DataFrame, k: int, width: int) -> np.ndarray:
    """Sum of the vectors of each cluster: added up per task, then by Spark, ``k * width`` rows to the driver."""

    def adding(batches):
        total = np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            x = np.asarray(batch.column("v").flatten()).reshape(-1, width).astype(np.int64)
            cluster = np.asarray(batch.column("cluster"))
            for i in np.unique(cluster).tolist():
                total[i] += x[cluster == i].sum(axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "part"])

    parts = state.select("v", "cluster").mapInArrow(adding, "at long, part long")
    out = np.zeros(k * width, dtype=object)
    for r in parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        out[r["at"]] = int(r["total"])
    return out.reshape(k, width)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hex sha256 of ``seed:key``, in that order; ties by components, null keys last."""
    named = F.concat(F.lit(f"{seed}:"), F.col("key").cast("string"))
    order = F.sha2(named.cast("binary"), 256)
    rows = vectors.select(order.alias("o"), "v").orderBy(F.asc_nulls_last("o"), "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
    width: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Every kept vector as ``key, cluster, distance, cluster_inertia, inertia, centroid_sha256, scans``; ``key`` keeps its name.

    Vectors with exactly ``width`` components, none null or non-finite, are kept and turned into whole numbers
    floor(256 x); a number whose squared distances could not be held in a long stops the job. The first centroids are those of
    ``first_centroids``, fewer if there are fewer vectors. Each of ``rounds`` rounds assigns every vector to the nearest centroid (squared
    Euclidean distance, ties to the smaller number) and moves each non-empty centroid to floor(sum / count); then vectors are assigned once
    more. All of this is exact. ``scans`` counts the assignments in which a vector was compared with all centroids: in the others its
    bound, loosened by ``loosening``, proved that its own is still the nearest.

    Repeated rows are vectors each; null keys take part. Other columns are left out. An empty table gives no rows. The state
    is two tables written in turn; the driver holds the centroids, ``k * width`` numbers.
    """
    spark = vectors.sparkSession
    outputs = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")
    if key in outputs:
        raise ValueError(f"{key} is the name of an output column")
    start = save(scaled(vectors, key, vector, width), "vectors")
    centroids = first_centroids(start, k, seed)
    state = start.select(
        "key", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
        F.lit(0.0).alias("lower"), F.lit(0).alias("scans"),
    )
    if not len(centroids):
        centroids, rounds = np.zeros((1, width), dtype=np.int64), 0
    loses, write = None, alternating(spark, "clusters")
    for turn in range(rounds + 1):
        state = write(_assigned(state, centroids, loses))
        groups = state.groupBy("cluster").agg(
            F.count("*").alias("n"), F.max("distance").alias("far"),
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"),
        ).collect()
        if turn == rounds:
            break
        sums, moved, radius = _component_sums(state, len(centroids), width), centroids.copy(), np.zeros(len(centroids))
        for g in groups:
            moved[g.cluster] = [int(s) // g.n for s in sums[g.cluster]]
            radius[g.cluster] = math.sqrt(g.far) * (1 + SLACK)
        loses, centroids = loosening(centroids, moved, radius), moved
    whole = sum(int(g.inertia) for g in groups)
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    rows = [(g.cluster, int(g.inertia), whole, digest(centroids[g.cluster])) for g in groups]
    found = spark.createDataFrame(rows, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(found), F.col("cluster") == F.col("c")).select(
        F.col("key").alias(key), *outputs
    )
