"""Approximate nearest neighbours: cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tallyworks.llm.store import save

#: Tables, and cells probed in each; measured recall in the README.
TABLES, PROBES = 8, 12

#: Vectors of one cell held in memory at once; a fuller cell is split, and probed in all its parts.
CELL_ROWS = 4096

SEED = 7


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-random rotation: three rounds of random signs and a fast Hadamard transform. Rows are vectors."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), n))
    out[:, : x.shape[1]] = x
    random = np.random.default_rng(seed)
    for _ in range(3):
        out *= random.choice([-1.0, 1.0], n)
        h = 1
        while h < n:
            pairs = out.reshape(len(x), -1, 2, h)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            out = out.reshape(len(x), n)
            h *= 2
    return out / n**1.5


def nearest_axes(x: np.ndarray, table: int, probes: int, hashes: int) -> np.ndarray:
    """Cells of a table for every row of ``x``, best first: numbers of the nearest signed axes.

    ``hashes`` rotations are combined; of the combinations those that lose least are taken.
    """
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cells, loss, base = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1)), 1
    for k in range(hashes):
        along = rotated(unit, SEED + 1000 * table + k)
        signed = np.concatenate([along, -along], axis=1)
        axes = np.argsort(-signed, axis=1, kind="stable")[:, :probes]
        lost = signed.max(axis=1, keepdims=True) - np.take_along_axis(signed, axes, axis=1)
        both = (loss[:, :, None] + lost[:, None, :]).reshape(len(x), -1)
        names = (cells[:, :, None] * signed.shape[1] + axes[:, None, :]).reshape(len(x), -1)
        best = np.argsort(both, axis=1, kind="stable")[:, :probes]
        cells, loss = np.take_along_axis(names, best, axis=1), np.take_along_axis(both, best, axis=1)
        base *= signed.shape[1]
    return cells


def usable(vector: str) -> Column:
    """Not null or empty, all components finite and given, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _cells(vectors: DataFrame, tables: int, probes: int, hashes: int, role: int) -> DataFrame:
    """One row for every cell of every vector: ``cell, role, name, first, v``."""

    def hashing(batches):
        for batch in batches:
            flat = batch.column("v")
            name, first = batch.column("name"), batch.column("first")
            values = np.asarray(flat.values.to_numpy(zero_copy_only=False))
            ends = np.asarray(flat.offsets)
            lengths = np.diff(ends)
            for width in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == width)
                x = values[ends[rows][:, None] + np.arange(width)].astype(np.float64)
                for table in range(tables):
                    cells = nearest_axes(x, table, probes, hashes)
                    for j in range(cells.shape[1]):
                        keys = [f"{width}:{table}:{c}" for c in cells[:, j].tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), pa.array(np.full(len(rows), role, dtype=np.int32))]
                            + [c.take(pa.array(rows)) for c in (name, first, flat)],
                            names=["cell", "role", "name", "first", "v"],
                        )

    kind = vectors.schema["v"].dataType.simpleString()
    schema = f"cell string, role int, name long, first long, v {kind}"
    return vectors.select("name", "first", "v").mapInArrow(hashing, schema)


def _nearest_in_cells(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query, name, score)``: the ``k`` nearest points of every query in every part of a cell it probes."""
    parts = points.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"))
    dealt = points.join(parts, "cell").withColumn(
        "part", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int")
    )
    asked = queries.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["cell", "part", "role", "name", "first", "v"]
    rows = dealt.select(*columns).unionByName(asked.select(*columns))
    ordered = rows.repartition("cell", "part").sortWithinPartitions("cell", "part", "role")

    def searching(batches):
        at, held, names, x, known, least = None, [], [], None, None, None
        for batch in batches:
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("part").to_pylist()))
            role, name, first = (np.asarray(batch.column(c)) for c in ("role", "name", "first"))
            flat = batch.column("v")
            values, ends = np.asarray(flat.values), np.asarray(flat.offsets)
            out = []
            begin = 0
            while begin < len(keys):
                end = begin
                while end < len(keys) and keys[end] == keys[begin] and role[end] == role[begin]:
                    end += 1
                if keys[begin] != at:
                    at, held, names, x = keys[begin], [], [], None
                part = values[ends[begin] : ends[end]].reshape(end - begin, -1).astype(np.float64)
                if role[begin] == 0:
                    held.append(part)
                    names.append((name[begin:end], first[begin:end]))
                    x = None
                elif held:
                    if x is None:
                        x, (known, least) = np.concatenate(held), map(np.concatenate, zip(*names))
                        held, names = [x], [(known, least)]
                    for i, q in enumerate(part):
                        distance = np.sqrt(((x - q) ** 2).sum(axis=1))
                        near = np.arange(len(x))
                        if len(x) > k:  # all up to the k-th smallest distance, of those tied the smallest keys
                            near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
                        near = near[np.lexsort((least[near], distance[near]))][:k]
                        out.append((np.full(len(near), name[begin + i]), known[near], distance[near]))
                begin = end
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)], names=["query", "name", "score"]
                )

    return ordered.mapInArrow(searching, "query long, name long, score double")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    hashes: int = 1,
) -> DataFrame:
    """The ``k`` nearest rows found for every query: ``query_id, rank, vec_id, score``.

    ``queries`` are rows of ``vectors``; a query's own key is no candidate. ``score`` is the Euclidean distance
    of the original vectors in double precision, ties go to smaller keys.
    Vectors that are null, empty, all zero or hold null or non-finite components take no part; vectors of another length
    are not compared. Rows repeated in full count once; a key with several vectors is several rows.

    Equal vectors are one point that carries the ``k + 1`` smallest keys, all that
    any query can need of it. Every table rotates the unit vectors and gives each to
    the nearest signed axis; queries probe the nearest ``probes`` axes, and meet the points of these
    cells in tasks that hold one part of a cell. What is near in a part is ranked before it is
    shuffled. A query that finds fewer than ``k + 1`` keys is compared with all vectors,
    cell by cell of one table.
    """
    # single precision travels as such and is widened where distances are taken
    single = vectors.schema[vector].dataType.elementType == FloatType()
    kind = "array<float>" if single else "array<double>"

    def clean(table):
        named = table.where(usable(vector) & F.col(key).isNotNull())
        return named.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v")).distinct()

    rows, asked = clean(vectors), clean(queries)
    few = Window.partitionBy("v").orderBy("id")
    held = rows.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= k + 1)
    merged = held.groupBy("v").agg(F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids"))
    points = save(merged.withColumn("name", F.monotonically_increasing_id()), "points")
    distinct = asked.select("v").distinct().withColumn("name", F.monotonically_increasing_id())
    distinct = save(distinct.withColumn("first", F.lit(0).cast("long")), "queries")
    named = asked.join(distinct.select("v", F.col("name").alias("query")), "v").select("id", "query")

    def search(questions, tables, probes):
        return _nearest_in_cells(
            _cells(points, tables, 1, hashes, 0), _cells(questions, tables, probes, hashes, 1), k + 1
        )

    def expanded(found):
        return (
            found.groupBy("query", "name").agg(F.min("score").alias("score"))
            .join(points.select("name", "ids"), "name")
            .select("query", F.explode("ids").alias("vec_id"), "score")
        )

    found = save(expanded(search(distinct, tables, probes)), "found")
    counts = found.groupBy("query").agg(F.count("*").alias("_n"))
    short = save(
        distinct.join(counts, distinct["name"] == counts["query"], "left")
        .where(F.coalesce("_n", F.lit(0)) <= k).select("name", "first", "v"),
        "short",
    )
    if short.limit(1).count():
        found = found.join(short, found["query"] == short["name"], "left_anti").unionByName(
            expanded(search(short, 1, 1 << 20))
        )
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    top = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")
    answers = named.select("id", "query").join(top, "query").where("vec_id <> id")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", "vec_id", "score"
    )
