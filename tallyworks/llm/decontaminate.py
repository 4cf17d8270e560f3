"""Benchmark decontamination: test n-grams in a broadcast hash set, token windows scanned against it."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.rows import packed, unpacked
from tallyworks.llm.store import save, small_batches

#: Windows of test items that are broadcast at once (about 500 bytes each in a worker).
BLOCK_WINDOWS = 200_000

#: Bytes to word bytes: A-Z becomes a-z, digits, a-z and all of UTF-8 beyond ASCII stay, the rest splits words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words: runs of ASCII letters in lower case, digits and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split() if text else []


def benchmark_windows(benchmark: DataFrame, width: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``(gram, item)`` of ``width`` consecutive words; an item of fewer words is one window."""
    picked = small_batches(benchmark).select(
        F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text")
    )

    def windows(batches):
        for batch in batches:
            grams, items = [], []
            for name, raw in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(raw)
                for i in range(max(1, len(words) - width + 1) if words else 0):
                    grams.append(b" ".join(words[i : i + width]))
                    items.append(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.binary()), pa.array(items, pa.string())], names=["gram", "item"]
            )

    return picked.mapInArrow(windows, "gram binary, item string").distinct()


class GramSet:
    """A hash set of word windows: rolling hashes of word numbers, verified word by word.

    Windows of one length share one table: sorted 64-bit hashes, and the word
    numbers of every window beside them, so that a hit is compared exactly.
    """

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        self.items: dict[bytes, set] = {}
        for gram, item in pairs:
            self.items.setdefault(gram, set()).update(() if item is None else (item,))
        self.numbers: dict[bytes, int] = {}
        tables: dict[int, list[tuple[int, ...]]] = {}
        for gram in self.items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in gram.split())
            tables.setdefault(len(ids), []).append(ids)
        self.tables = {}
        for width, rows in tables.items():
            matrix = np.array(rows, dtype=np.int64)
            hashes = self.hashes(matrix.T)
            order = np.argsort(hashes, kind="stable")
            self.tables[width] = (hashes[order], matrix[order])

    def hashes(self, columns) -> np.ndarray:
        total = np.zeros(len(columns[0]), dtype=np.uint64)
        for column in columns:
            total = (total ^ (total >> np.uint64(29))) * self.MULTIPLIER + column.astype(np.uint64)
        return total

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged stretches of hit words, and the items that own the windows found."""
        ids = np.fromiter(map(self.numbers.get, words, [0] * len(words)), dtype=np.int64, count=len(words))
        stretches, items = [], set()
        for width, (hashes, matrix) in self.tables.items():
            n = len(ids) - width + 1
            if n < 1:
                continue
            # windows with a word outside the vocabulary can't be test windows
            unknown = np.concatenate([[0], np.cumsum(ids == 0)])
            starts = np.flatnonzero(unknown[width:] == unknown[:n])
            if not len(starts):
                continue
            found = self.hashes([ids[starts + k] for k in range(width)])
            at = np.searchsorted(hashes, found)
            live = at < len(hashes)
            starts, found, at = starts[live], found[live], at[live]
            while len(starts):  # equal hashes of different windows lie side by side
                live = hashes[at] == found
                starts, found, at = starts[live], found[live], at[live]
                same = np.ones(len(starts), dtype=bool)
                for k in range(width):
                    same &= matrix[at, k] == ids[starts + k]
                for s in starts[same].tolist():
                    stretches.append((s, s + width))
                    items |= self.items[b" ".join(words[s : s + width])]
                starts, found, at = starts[~same], found[~same], at[~same] + 1
                live = at < len(hashes)
                starts, found, at = starts[live], found[live], at[live]
        return merged(stretches), items


def merged(stretches) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", block: int = BLOCK_WINDOWS):
    """Add ``n_words``, ``hits`` (stretches of hit words) and ``items`` (test items found) to every row of ``docs``.

    The test windows are broadcast in blocks of at most ``block`` (window, item)
    pairs, counted beforehand. A larger benchmark takes more blocks, each one
    more scan of the texts, whose findings are joined row by row: documents
    are never shuffled. Null or empty text has no words; an item without words has
    no window; hits of an item without id count, but name no item. Rows
    repeated stay repeated. Texts of any length are scanned whole. Columns of ``docs`` named like one of the three added are replaced;
    all others stay as they are.
    """
    spark = docs.sparkSession
    windows = save(benchmark_windows(benchmark, width), "windows")
    blocks = max(1, math.ceil(windows.count() / block * (1.1 if windows.count() > block else 1)))
    out = small_batches(packed(docs, text)).select(
        "*",
        F.col(text).cast("binary").alias("_raw"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:int,end:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("gram", "item"), F.lit(blocks)) == b)
        grams = spark.sparkContext.broadcast([(bytes(r.gram), r.item) for r in part.collect()])
        out = _scan_block(out if b == 0 else save(out, "scanned"), grams)
    added = ("n_words", "hits", "items")
    return out.select(*unpacked(docs, text, without=added), *added)


def _scan_block(docs: DataFrame, grams) -> DataFrame:
    hits_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scanning(batches):
        known = GramSet(grams.value)
        for batch in batches:
            counts, hits, items = [], [], []
            old = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for raw, (had, named) in zip(batch.column("_raw").to_pylist(), old):
                words = words_of(raw)
                found, owners = known.scan(words) if words else ([], set())
                if had:
                    found = merged(found + [(h["start"], h["end"]) for h in had])
                counts.append(len(words))
                hits.append([{"start": s, "end": e} for s, e in found])
                items.append(sorted(owners | set(named)))
            arrays = {
                "n_words": pa.array(counts, pa.int64()),
                "hits": pa.array(hits, hits_type),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(
                [arrays.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)],
                names=batch.schema.names,
            )

    return docs.mapInArrow(scanning, docs.schema)


def flag(docs: DataFrame, benchmark: DataFrame, width: int = 10, key: str = "doc_id") -> DataFrame:
    """One row per document: words, hit words, the test items found and whether it is contaminated."""
    found = scan(docs.select(key, "text"), benchmark, width)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["end"] - h["start"])
    return found.select(
        key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Rows of ``docs`` in which no test window occurs, with all their columns."""
    return scan(packed(docs, "text"), benchmark, width).where(F.size("hits") == 0).select(*unpacked(docs, "text"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text") -> DataFrame:
    """Cut the hit stretches out of the texts; what separates the words around them stays."""
    found = scan(packed(docs, text), benchmark, width, text)
    schema = found.schema

    def cutting(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = []
            for value, hits in zip(batch.column(at).to_pylist(), batch.column("hits").to_pylist()):
                texts.append(cut(value, [(h["start"], h["end"]) for h in hits]) if hits else value)
            arrays = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return found.mapInArrow(cutting, schema).select(*unpacked(docs, text))


def cut(text: str, stretches: list[tuple[int, int]]) -> str:
    """Remove words ``start`` to ``end`` of every stretch from ``text``."""
    raw = text.encode()
    clean = raw.translate(WORD_BYTES)
    bounds, at = [], 0
    for word in clean.split():
        at = clean.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    out, done = [], 0
    for start, end in stretches:
        out.append(raw[done : bounds[start][0]])
        done = bounds[end - 1][1]
    return b"".join([*out, raw[done:]]).decode()

