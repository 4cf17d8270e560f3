"""SimHash near-duplicates: fingerprints, and a vantage-point tree that finds all pairs within a few bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.rows import CALLER, packed, unpacked
from tallyworks.llm.store import save, small_batches

#: Seed of the shingle hash.
SEED = 42

#: Fingerprints of one leaf shard, and the most fingerprints sampled to build the tree.
LEAF_ROWS = 16_384
SAMPLE_ROWS = 1 << 20

#: Comparisons done at once inside a leaf (a byte or eight each).
CELLS = 1 << 20

#: Shingles hashed at once: a long text is added up in pieces.
PIECE = 1 << 16


def fingerprint(text: bytes | None, width: int) -> int:
    """64-bit SimHash of the word shingles of a text; 0 without words.

    Words are runs of non-blank bytes with A-Z in lower case. A bit is set if
    more than half of the shingle hashes have it.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    lasts = ends[min(width, len(words)) - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PIECE):
        spans = zip(starts[at : min(n, at + PIECE)].tolist(), lasts[at : at + PIECE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)`` of every row; the 64 bits are held in a signed long."""
    picked = small_batches(docs).select(key, F.col(text).cast("binary").alias("_raw"))

    def hashing(batches):
        for batch in batches:
            values = np.array([fingerprint(t, width) for t in batch.column("_raw").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(values.view(np.int64))], names=[key, "fingerprint"]
            )

    schema = picked.select(key).schema.add("fingerprint", "long")
    return picked.mapInArrow(hashing, schema)


def grown(sample: np.ndarray, rows: int, leaf_rows: int, radius: int) -> tuple[int, list[tuple], int]:
    """A vantage-point tree over 64-bit fingerprints: ``(root, inner nodes, number of leaves)``.

    A node is ``(vantage point, distance, left, right)``: fingerprints up to that
    distance from the vantage point go left, others right. Children are node
    numbers, leaves ``-1 - n``. Leaves are meant to hold ``leaf_rows`` of ``rows``.
    """
    nodes: list[tuple] = []
    leaves = 0
    weight = rows / max(1, len(sample))

    def grow(part: np.ndarray) -> int:
        nonlocal leaves
        best = None
        if len(part) * weight > leaf_rows and len(part) >= 32:
            # of a few candidates, the split with the fewest fingerprints near its boundary
            for v in part[:: max(1, len(part) // 8)][:8]:
                distance = np.bitwise_count(part ^ v).astype(np.int64)
                for mu in np.unique(np.quantile(distance, [0.4, 0.5, 0.6], method="lower")).tolist():
                    left = distance <= mu
                    if 0.2 <= left.mean() <= 0.8:
                        near = ((distance > mu - radius) & (distance <= mu + radius)).mean()
                        if best is None or near < best[0]:
                            best = (near, v, mu, left)
        if best is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(())
        nodes[at] = (int(best[1]), best[2], grow(part[best[3]]), grow(part[~best[3]]))
        return at

    return grow(sample), nodes, leaves


def route(root: int, nodes: list[tuple], radius: int, prints: np.ndarray):
    """Yield ``(leaf, home, guests)``: every fingerprint once at home, and as a guest where a partner may be.

    By the triangle inequality partners differ by at most the radius in their
    distance to a vantage point. A pair that a boundary separates is met once:
    its left fingerprint visits the right side.
    """
    todo = [(root, prints, prints[:0])]
    while todo:
        node, home, guests = todo.pop()
        if not len(home) and not len(guests):
            continue
        if node < 0:
            yield -1 - node, home, guests
            continue
        v, mu, left, right = nodes[node]
        at_home, at_guests = (np.bitwise_count(x ^ np.uint64(v)).astype(np.int64) for x in (home, guests))
        crossing = home[(at_home <= mu) & (at_home > mu - radius)]
        todo.append((left, home[at_home <= mu], guests[at_guests <= mu + radius]))
        todo.append((right, home[at_home > mu], np.concatenate([crossing, guests[at_guests > mu - radius]])))


def near_pairs(queries: np.ndarray, points: np.ndarray, radius: int):
    """All ``(query, point)`` within ``radius`` bits, found by descending a vantage-point tree of the points."""
    todo = [(queries, points)]
    while todo:
        q, p = todo.pop()
        if not len(q) or not len(p):
            continue
        if len(p) > 64 and len(q) > 8:
            v = p[len(p) // 2]
            to_p = np.bitwise_count(p ^ v).astype(np.int64)
            mu = int(np.median(to_p))
            left = to_p <= mu
            if not left.all():
                to_q = np.bitwise_count(q ^ v).astype(np.int64)
                todo.append((q[to_q <= mu + radius], p[left]))
                todo.append((q[to_q > mu - radius], p[~left]))
                continue
        step = max(1, CELLS // len(p))
        for at in range(0, len(q), step):
            piece = q[at : at + step]
            a, b = np.nonzero(np.bitwise_count(piece[:, None] ^ p[None, :]) <= radius)
            if len(a):
                yield piece[a], p[b]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges that connect what the edges ``a``-``b`` connect: every node to the least of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        for end in (u, v):
            np.minimum.at(new, end, least)
            np.minimum.at(new, label[end], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(prints: DataFrame, radius: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the distinct ``fingerprint`` values within ``radius`` bits.

    A tree grown from a bounded sample deals the fingerprints into leaf shards,
    with visitors where a shard overlaps a boundary; every shard searches its
    fingerprints exactly, in memory, with visitors streaming past. Of the pairs
    found each shard returns a spanning set, so a large group of near copies
    costs one edge each, not all pairs. An empty table gives no edges.
    """
    spark = prints.sparkSession
    rows = prints.count()
    share = min(1.0, SAMPLE_ROWS / max(1, rows), max(4096, 256 * rows / leaf_rows) / max(1, rows))
    picked = prints.where(F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = np.sort(picked.select("fingerprint").toArrow().column(0).to_numpy()).view(np.uint64)
    root, nodes, _ = grown(np.random.default_rng(SEED).permutation(sample), rows, leaf_rows, radius)
    tree = spark.sparkContext.broadcast(nodes)

    def routing(batches):
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            for leaf, home, guests in route(root, tree.value, radius, values):
                both = np.concatenate([home, guests])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(both), leaf, dtype=np.int64)),
                        pa.array(np.repeat([False, True], [len(home), len(guests)])),
                        pa.array(both.view(np.int64)),
                    ],
                    names=["leaf", "guest", "fingerprint"],
                )

    def searching(batches):
        points, queries, shard = [], [], None

        def flush(done):
            nonlocal points, queries
            home = points[0] if len(points) == 1 else np.concatenate([*points, np.empty(0, np.uint64)])
            points = [home]
            found = list(near_pairs(np.concatenate([*queries, np.empty(0, np.uint64)]), home, radius))
            if done:
                found += list(near_pairs(home, home, radius))
                points = []
            queries = []
            pairs = [(a[a != b], b[a != b]) for a, b in found]
            a, b = (np.concatenate([np.empty(0, np.uint64), *(p[i] for p in pairs)]) for i in (0, 1))
            if len(a):
                a, b = spanning(a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

        for batch in batches:
            leaf, guest, value = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3))
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(leaf)]):
                if s == e:
                    continue
                if shard != leaf[s]:
                    if shard is not None:
                        yield from flush(True)
                    shard = leaf[s]
                part = value[s:e].view(np.uint64)
                points.append(part[~guest[s:e]])
                queries.append(part[guest[s:e]])
                if sum(map(len, queries)) > 1 << 16:
                    yield from flush(False)
        if shard is not None:
            yield from flush(True)

    dealt = prints.select("fingerprint").mapInArrow(routing, "leaf long, guest boolean, fingerprint long")
    sorted_shards = dealt.repartition("leaf").sortWithinPartitions("leaf", "guest")
    return sorted_shards.mapInArrow(searching, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id", leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest key that chains of fingerprints within
    ``radius`` bits reach. Rows with equal fingerprints meet as one, so copies
    are never paired with each other. Null and empty texts have fingerprint zero and
    link like any other. A null key is never the smallest; a component of
    null keys alone has a null id. Repeated rows stay repeated.
    """
    prints = save(fingerprints(docs, width, key), "prints")
    classes = save(prints.groupBy("fingerprint").agg(F.min(key).alias("_first")), "classes")
    roots = components(links(classes, radius, leaf_rows), "a", "b")
    rooted = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_first", F.coalesce("root", "fingerprint").alias("_root")
    )
    firsts = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = rooted.join(firsts, "_root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component_id")


def deduplicate(docs: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id") -> DataFrame:
    """Keep, of every group of near duplicates, the row with the smallest key.

    Rows with one key but different texts are different documents, told apart by a hash of the text;
    of rows with the same key and text one stays. Rows with a null key can't be
    named as copies of another: they all stay. All columns stay, whatever their names.
    """
    told = F.struct(F.col(key).alias("key"), F.xxhash64("text").alias("row"))
    named = docs.select(F.when(F.col(key).isNotNull(), told).alias("_doc"), "text")
    kept = near_duplicates(named, width, radius, "_doc").where(F.col("_doc") == F.col("component_id"))
    kept = kept.select(F.col("_doc.key").alias("_key"), F.col("_doc.row").alias("_hash")).distinct()
    rows = packed(docs, key, "text").withColumn("_row", F.xxhash64("text"))
    first = rows.join(kept, (rows[key] == kept["_key"]) & (rows["_row"] == kept["_hash"]), "left_semi")
    one = Window.partitionBy(key, "_row").orderBy(F.xxhash64(F.lit(0), CALLER))
    first = first.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return first.select(*unpacked(docs, key, "text")).unionByName(docs.where(F.col(key).isNull()))
