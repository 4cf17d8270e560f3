"""Substring deduplication: suffixes split by prefix into groups that fit in memory, repeats found group by group."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.store import save, small_batches

#: Text bytes of one block of documents, and suffixes of one group: what a task holds in memory.
BLOCK_BYTES = 5 << 20
GROUP_ROWS = 1_000_000

#: Prefix lengths, in words, at which suffixes are split; a prefix that is too frequent passes on to the next.
PREFIXES = (2, 5)

#: Counters for each prefix length: a fixed table, however many prefixes there are.
BUCKETS = 1 << 16

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xC2B2AE3D27D4EB4F)


def packed(values: np.ndarray) -> bytes:
    """Numbers as bytes, equal places of all numbers side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def unpacked(raw: bytes, kind) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(rows.reshape(width, -1).T).reshape(-1).view(kind)


class Block:
    """Some documents, in order of id, and the suffixes of their words cut at ``width`` words.

    The words of all documents lie in one row; ``ids`` and ``ends`` give each document's
    id and where its words end. Only suffixes of at least ``width`` words count.
    """

    def __init__(self, rows: list[tuple[int | None, bytes | None]], width: int):
        self.rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        self.width = width
        self.words = [text.split() if text else [] for _, text in self.rows]
        counts = np.array([len(w) for w in self.words], dtype=np.int64)
        self.ends = np.cumsum(counts)
        self.ids = np.array([0 if i is None else i for i, _ in self.rows], dtype=np.int64)
        # documents without id neither remove nor lose anything
        usable = np.array([i is not None for i, _ in self.rows], dtype=bool)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        left = self.ends[self.doc] - np.arange(len(self.doc))
        self.starts = np.flatnonzero((left >= width) & usable[self.doc])

    def hashes(self, widths: tuple[int, ...]) -> list[np.ndarray]:
        """64-bit hashes of the first ``w`` words of every suffix, for each ``w``; last, 16 more bits of the whole."""
        digest = xxhash.xxh3_64_intdigest
        words = np.array([digest(w) for doc in self.words for w in doc], dtype=np.uint64)
        out, h, g = [], np.zeros(len(self.starts), np.uint64), np.zeros(len(self.starts), np.uint64)
        for k in range(max(widths)):
            word = words[self.starts + k]
            h = (h ^ (h >> np.uint64(31))) * MIX + word
            g = (g ^ (g >> np.uint64(29))) * MIX_2 + word
            if k + 1 in widths:
                out.append((h ^ (h >> np.uint64(32))) * MIX)
        return [*out, (g >> np.uint64(48)).astype(np.uint16)]

    def nodes(self, groups: "Groups"):
        """The distinct suffixes: ``(order, first of each run, group, hash, more bits)``, ordered by group and hash.

        Suffixes of one node are a run in ``order``, by document.
        """
        *short, full, more = self.hashes((*PREFIXES, self.width))
        order = np.argsort(full, kind="stable")
        h, x = full[order], more[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (x[1:] != x[:-1])]) if len(h) else order
        at = order[first]
        group = groups.of([s[at] for s in short], full[at])
        by_group = np.argsort(group, kind="stable")
        return order, first, by_group, group[by_group], h[first][by_group], x[first][by_group]


class Groups:
    """Which group a suffix falls into: by its shortest prefix that is rare enough.

    ``counts`` holds, for each prefix length, how many suffixes fall into each
    of the hash buckets. Buckets up to ``rows`` suffixes are packed into groups of
    about ``rows``; suffixes of fuller buckets go by their next prefix, and at last by
    the whole window, into as many groups as it takes.
    """

    def __init__(self, counts: list[np.ndarray], rows: int):
        self.tables, base = [], 0
        for count in counts:
            fits = count <= rows
            table = base + np.cumsum(np.where(fits, count, 0)) // rows
            base = int(table[-1]) + 1
            self.tables.append(np.where(fits, table, -1))
            rest = int(count[~fits].sum())
        self.base, self.last = base, -(-rest // rows)

    def of(self, short: list[np.ndarray], full: np.ndarray) -> np.ndarray:
        group = np.full(len(full), -1, dtype=np.int64)
        for table, h in zip(self.tables, short):
            bucket = (h >> np.uint64(48)).astype(np.int64)
            group = np.where(group < 0, table[bucket], group)
        if self.last:
            group = np.where(group < 0, self.base + (full % np.uint64(self.last)).astype(np.int64), group)
        return group


def blocks_of(batches, block_bytes: int, width: int):
    """Yield ``(name, Block)`` for the documents of one task, some megabytes at a time.

    The name is made of task, number and content: the same in every pass over the same input.
    """
    rows, size, n = [], 0, 0
    task = TaskContext.get().partitionId()

    def named():
        content = hashlib.md5(repr([(i, len(t or b"")) for i, t in rows]).encode()).hexdigest()
        return f"{task}-{n}-{content}", Block(rows, width)

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((i, text))
            size += len(text or b"") + 100
            if size >= block_bytes:
                yield named()
                rows, size, n = [], 0, n + 1
    if rows:
        yield named()


def remove_repeats(
    docs: DataFrame,
    width: int = 13,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Cut every word covered by ``width`` words in a row that also start in a document with a smaller key.

    Returns ``(key, n_words, n_removed, kept_text, repeats)`` for every row, the kept words joined by
    one space; ``repeats`` are the maximal stretches of words removed, from ``start`` up to ``end``. Words are separated by ASCII blanks; null and empty texts have none. Judged
    on the input, not on what is left. Rows with the same key do not remove from
    each other, rows with a null key neither remove nor lose anything.

    Every word starts a suffix. A first pass counts the suffixes by prefix, in
    tables of fixed size; prefixes of two words, five or the whole window, whichever is rare
    enough, split the suffixes into groups that fit in memory. In a second
    pass every block of documents sends each group its distinct suffixes, once for the
    smallest key, however often they occur. A group sorts its suffixes: equal runs are the
    tree's nodes at depth ``width``, all that deeper nodes can add, and neighbours in the
    text that are both repeated make up the maximal repeats. Back go bits, one for a suffix sent:
    whether a smaller key has it. In the last pass these meet the texts, block by block.
    A suffix travels as 80 hash bits of its first ``width`` words: two that differ
    are taken for equal with a probability of 2^-80.
    """
    picked = small_batches(docs).select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("raw"))

    def counting(batches):
        tables = [np.zeros(BUCKETS, dtype=np.int64) for _ in PREFIXES]
        for _, block in blocks_of(batches, block_bytes, width):
            for table, h in zip(tables, block.hashes(PREFIXES)):
                table += np.bincount((h >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
        for level, table in enumerate(tables):
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), level, dtype=np.int32)), pa.array(used), pa.array(table[used])],
                names=["level", "bucket", "n"],
            )

    counted = picked.mapInArrow(counting, "level int, bucket long, n long").groupBy("level", "bucket").agg(F.sum("n"))
    counts = [np.zeros(BUCKETS, dtype=np.int64) for _ in PREFIXES]
    for level, bucket, n in counted.collect():  # at most BUCKETS rows for each prefix length
        counts[level][bucket] = n
    groups = Groups(counts, group_rows)

    def sending(batches):
        for name, block in blocks_of(batches, block_bytes, width):
            order, first, by_group, group, h, x = block.nodes(groups)
            owner = block.ids[block.doc[block.starts[order[first][by_group]]]]
            cuts = np.flatnonzero(np.diff(group)) + 1 if len(group) else []
            spans = list(zip([0, *cuts], [*cuts, len(group)])) if len(group) else []
            for at in range(0, len(spans), 64):
                part = spans[at : at + 64]
                columns = [[name] * len(part), [int(group[s]) for s, _ in part]]
                columns += [[packed(np.diff(h[s:e], prepend=np.uint64(0))) for s, e in part]]
                columns += [[packed(v[s:e]) for s, e in part] for v in (x, owner)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), *[pa.binary()] * 3))],
                    names=["block", "group", "h", "x", "owner"],
                )

    def answering(batches):
        parts, current = [], None

        def answer():
            h = np.concatenate([np.cumsum(unpacked(p[1], np.uint64), dtype=np.uint64) for p in parts])
            x = np.concatenate([unpacked(p[2], np.uint16) for p in parts])
            owner = np.concatenate([unpacked(p[3], np.int64) for p in parts])
            lengths = [len(unpacked(p[2], np.uint16)) for p in parts]
            order = np.argsort(h, kind="stable")
            ties = np.flatnonzero(np.diff(h[order]) == 0)
            if len(ties) and (x[order[ties]] != x[order[ties + 1]]).any():
                order = np.lexsort((x, h))
            hs, xs, os = h[order], x[order], owner[order]
            first = np.flatnonzero(np.r_[True, (hs[1:] != hs[:-1]) | (xs[1:] != xs[:-1])])
            least = np.minimum.reduceat(os, first)
            later = np.empty(len(h), dtype=bool)
            later[order] = os > np.repeat(least, np.diff(np.r_[first, len(h)]))
            bits = [np.packbits(b).tobytes() for b in np.split(later, np.cumsum(lengths)[:-1])]
            names = pa.array([p[0] for p in parts], pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(np.full(len(parts), current, dtype=np.int64)), pa.array(bits, pa.binary())],
                names=["block", "group", "data"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("group", "block", "h", "x", "owner")]
            for group, *part in zip(*columns):
                if parts and group != current:
                    yield from answer()
                    parts = []
                current = group
                parts.append(part)
        if parts:
            yield from answer()

    sent = picked.mapInArrow(sending, "block string, group long, h binary, x binary, owner binary")
    by_group = sent.repartition("group").sortWithinPartitions("group", "block")
    answers = save(by_group.mapInArrow(answering, "block string, group long, data binary"), "answers")

    def texts(batches):
        for name, block in blocks_of(batches, block_bytes, width):
            raw = zstandard.compress(pickle.dumps(block.rows), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([-1], pa.int64()), pa.array([raw], pa.binary())],
                names=["block", "group", "data"],
            )

    def cutting(batches):
        block, bits, name = None, [], None

        def results():
            order, first, by_group, group, *_ = block.nodes(groups)
            flags = np.empty(len(first), dtype=bool)
            flags[by_group] = answered(bits, group)
            lengths = np.diff(np.r_[first, len(order)]) if len(first) else np.empty(0, dtype=np.int64)
            owner = np.repeat(block.ids[block.doc[block.starts[order[first]]]], lengths)
            gone = np.repeat(flags, lengths) | (block.ids[block.doc[block.starts[order]]] > owner)
            change = np.zeros(len(block.doc) + 1, dtype=np.int64)
            hit = block.starts[order[gone]]
            np.add.at(change, hit, 1)
            np.add.at(change, hit + width, -1)
            covered = np.cumsum(change[:-1]) > 0
            begin = 0
            for at in range(0, len(block.rows), 500):
                ids, counts, cuts, kept, spans = [], [], [], [], []
                for (i, _), words in zip(block.rows[at : at + 500], block.words[at : at + 500]):
                    mask = covered[begin : begin + len(words)]
                    begin += len(words)
                    n = int(mask.sum())
                    ids.append(i)
                    counts.append(len(words))
                    cuts.append(n)
                    kept.append(b" ".join([w for w, m in zip(words, mask.tolist()) if not m] if n else words).decode())
                    edges = np.flatnonzero(np.diff(np.r_[0, mask, 0])).tolist() if n else []
                    spans.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
                kinds = (*[pa.int64()] * 3, pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip((ids, counts, cuts, kept, spans), kinds)],
                    names=[key, "n_words", "n_removed", "kept_text", "repeats"],
                )

        for batch in batches:
            for new, group, data in zip(*(batch.column(c).to_pylist() for c in ("block", "group", "data"))):
                if new != name:
                    if block is not None:
                        yield from results()
                    block, bits, name = None, [], new
                if group < 0:
                    block = Block(pickle.loads(zstandard.decompress(data)), width)
                else:
                    bits.append((group, data))
                if block is None:
                    raise RuntimeError("documents changed between two passes over them")
        if block is not None:
            yield from results()

    both = picked.mapInArrow(texts, answers.schema).unionByName(answers)
    joined = both.repartition("block").sortWithinPartitions("block", "group")
    return joined.mapInArrow(cutting, f"`{key}` long, n_words long, n_removed long, kept_text string, repeats array<struct<start:int,end:int>>")


def answered(bits: list[tuple[int, bytes]], group: np.ndarray) -> np.ndarray:
    """The answers to a block's suffixes, in its order of groups."""
    sent, counts = np.unique(group, return_counts=True)
    if [g for g, _ in bits] != sent.tolist():
        raise RuntimeError("documents changed between two passes over them")
    flags = [
        np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)
        for (_, data), n in zip(bits, counts.tolist())
    ]
    return np.concatenate([*flags, np.empty(0, dtype=bool)])
