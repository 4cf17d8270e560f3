"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks.llm.ordering import running
from tallyworks.llm.store import save, small_batches

#: Tokens of a sequence.
CAPACITY = 2048

#: The id that ends every document.
END_ID = 0

#: How many runs between blanks, and parts of them, a worker remembers, each of at most so many characters.
REMEMBERED, REMEMBERED_CHARS = 500_000, 64

#: The rule by which tokenizers of words drop white space and split lower-cased text.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Printable ASCII, the accented letters of Latin-1 and four signs, in which no character composes with another one;
#: and the same rule for them once they are lower-cased.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u00a1\u00ab\u00bb\u00bf]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

#: How byte-level models write bytes: printable ones of Latin-1 as they are, the others as the characters from 256 on, in order.
BYTE_MARKS = {b: 256 + n for n, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}

#: Pieces of an output batch hold so many ids at most, but for a single longer one.
BATCH_IDS = 2_000_000


class Encoder:
    """Ids of texts as bytes, little-endian unsigned 32-bit numbers.

    A tokenizer that lower-cases and splits by ``WORD_RULE`` has no token across a blank. Runs between blanks are then
    encoded on their own and looked up when they come again; those of plain characters are split here and go part by part to the
    tokenizer's model. Texts go whole to any other tokenizer.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        parts = json.loads(definition)
        steps = [s["type"] for s in (parts.get("normalizer") or {}).get("normalizers", [])]
        splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        rule = (splits.get("pattern") or {}).get("Regex"), splits.get("behavior"), splits.get("invert")
        self.by_runs = steps == ["NFC", "Replace", "Lowercase"] and rule == (WORD_RULE, "Removed", True)
        self.runs: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if not self.by_runs:
            return self.encode(text)
        for memory in (self.runs, self.parts):
            if len(memory) > REMEMBERED:
                memory.clear()
        runs = text.replace("\n", " ").replace("\t", " ").split(" ")
        found = list(map(self.runs.get, runs))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    found[at] = self.runs.get(runs[at]) or self._run(runs[at])
        return b"".join(found)

    def _run(self, run: str) -> bytes:
        """Ids of a new run; parts of plain characters go to the tokenizer's model as their bytes."""
        if not PLAIN.fullmatch(run):
            out = self.encode(run)
        else:
            out = b"".join([self.parts.get(p) or self._part(p) for p in PARTS.findall(run.lower())])
        if len(run) <= REMEMBERED_CHARS:
            self.runs[run] = out
        return out

    def _part(self, part: str) -> bytes:
        written = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_MARKS)
        ids = _as_bytes([t.id for t in self.model.tokenize(written)])
        if len(part) <= REMEMBERED_CHARS:
            self.parts[part] = ids
        return ids


def _as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder_of(definition) -> Encoder:
    """The encoder of a broadcast tokenizer file: one for each worker process, which outlives the worker's tasks."""
    if not hasattr(definition, "encoder"):
        definition.encoder = Encoder(definition.value)
    return definition.encoder


def cut(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Token pieces of every document, written once: ``key, piece, start, length, ids``; ``key`` keeps its name.

    A document is the ids of its text and ``end_id``. One longer than ``capacity`` is cut into pieces of that many ids, the last one
    shorter. ``ids`` are bytes, little-endian unsigned 32-bit numbers; ``start`` counts the document's ids before the piece.
    ``tokenizer`` is the path of a ``tokenizers`` file on the driver; its content travels to the workers. Null text is empty: one
    piece that holds ``end_id`` alone. Each row is a document of its own, also if keys are null or repeated. Texts of any length are
    encoded whole. Other columns are left out. An empty table has no pieces.
    """
    if key in ("piece", "start", "length", "ids"):
        raise ValueError(f"{key} is the name of an output column")
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = rows.select(key).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids", "binary")):
        schema = schema.add(name, kind)
    end, step, most = np.asarray([end_id], dtype="<u4").tobytes(), 4 * capacity, BATCH_IDS

    def encoding(batches: Iterator[pa.RecordBatch]):
        encoder = encoder_of(definition)
        for batch in batches:
            keys, texts = batch.columns
            at, piece, start, ids, held = [], [], [], [], 0

            def made():
                length = [len(i) // 4 for i in ids]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip((piece, start, length, ids), kinds)]
                return pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int64())), *columns], names=[key, "piece", "start", "length", "ids"]
                )

            for row in range(batch.num_rows):
                whole = encoder.ids(texts[row].as_py()) + end
                for n, begin in enumerate(range(0, len(whole), step)):
                    at.append(row)
                    piece.append(n)
                    start.append(begin // 4)
                    ids.append(whole[begin : begin + step])
                held += len(whole) // 4
                if held >= most:
                    yield made()
                    at, piece, start, ids, held = [], [], [], [], 0
            if at:
                yield made()

    return save(small_batches(rows).mapInArrow(encoding, schema), "pieces")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Kinds of bins for so many items of each length: ``(bins, ((length, items in each bin), ...))``.

    Items above a third of the capacity fit twice in a bin at most. They are matched greedily: from the longest on, each with the
    longest one left that fits beside it. Shorter items go, from the longest on, into the smallest gap that holds them, and
    into new bins where there is none. Items of one length and bins of one kind are dealt with together, so the work depends
    on the number of different lengths, not of items.
    """
    left = {n: c for n, c in counts.items() if c}
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    kinds: dict[int, list[list]] = {}  # by gap: [bins, contents]

    def put(bins: int, gap: int, contents: tuple) -> None:
        if bins:
            kinds.setdefault(gap, []).append([bins, contents])

    for i, a in enumerate(large):
        for b in large[i:]:
            if not left[a]:
                break
            if a + b > capacity or not left[b]:
                continue
            if a == b:
                pairs = left[a] // 2
                left[a] -= 2 * pairs
                put(pairs, capacity - 2 * a, ((a, 2),))
            else:
                pairs = min(left[a], left[b])
                left[a] -= pairs
                left[b] -= pairs
                put(pairs, capacity - a - b, ((a, 1), (b, 1)))
        put(left[a], capacity - a, ((a, 1),))
        left[a] = 0
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        items = left[n]
        while items:
            gap = min((g for g in kinds if g >= n and kinds[g]), default=None)
            if gap is None:
                fit = capacity // n
                put(items // fit, capacity - fit * n, ((n, fit),))
                put(1 if items % fit else 0, capacity - items % fit * n, ((n, items % fit),))
                break
            bins, contents = kinds[gap].pop()
            fit = gap // n
            full = min(bins, items // fit)
            items -= full * fit
            put(full, gap - fit * n, (*contents, (n, fit)))
            if full < bins:  # fewer items are left than one bin takes
                if items:
                    put(1, gap - items * n, (*contents, (n, items)))
                put(bins - full - (1 if items else 0), gap, contents)
                items = 0
    return [(bins, contents) for gap in sorted(kinds) for bins, contents in kinds[gap]]


def _slots(bins: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the places its items take in turn: first item, items a bin, first bin, offset in the bin."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    met: dict[int, int] = {}
    base = 0
    for number, contents in bins:
        offset = 0
        for length, each in contents:
            out.setdefault(length, []).append((met.get(length, 0), each, base, offset))
            met[length] = met.get(length, 0) + number * each
            offset += length * each
        base += number
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for length, rows in out.items()}


def place(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Rows of ``pieces`` with ``sequence_id`` and ``offset``: where each lies in as few sequences as can be.

    Lengths are from 1 to ``capacity``, anything else is an error. How many items there are of each length, ``capacity`` rows at most, decides
    the kinds of bins (``plan_bins``); the items of a length are numbered and take the places of that length in turn. Numbers
    come from running sums over ranges, so a length that a third of all items share spans many tasks. Sequences are numbered
    from 0 without gaps, and so are the tokens in each. Other columns are carried as they are; columns of ``pieces`` named
    ``sequence_id`` or ``offset`` are replaced. Equal rows take different places. No rows give no rows.
    """
    counted = pieces.groupBy(F.col(length).cast("long").alias("n")).count().limit(capacity + 1).collect()
    if any(r.n is None or not 1 <= r.n <= capacity for r in counted):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slots = _slots(plan_bins({r.n: r["count"] for r in counted}, capacity))
    carried = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(
        F.struct(*carried).alias("row"), F.col(length).cast("long").alias("n"), F.lit(1).alias("one"),
        F.monotonically_increasing_id().alias("at"),
    )
    ranked = running(rows, ["n"], ["at"], "one", "rank").select("row", "n", F.col("rank").cast("long").alias("rank"))
    schema = ranked.select("row").schema.add("sequence_id", "long").add("offset", "long")

    def placing(batches):
        for batch in batches:
            n, rank = (np.asarray(batch.column(c)) for c in ("n", "rank"))
            sequence, offset = np.empty(len(n), dtype=np.int64), np.empty(len(n), dtype=np.int64)
            for value in np.unique(n).tolist():
                here = np.flatnonzero(n == value)
                first, each, base, begin = slots[value]
                kind = np.searchsorted(first, rank[here], side="right") - 1
                turn = rank[here] - first[kind]
                sequence[here] = base[kind] + turn // each[kind]
                offset[here] = begin[kind] + turn % each[kind] * value
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"]
            )

    return ranked.mapInArrow(placing, StructType(schema.fields)).select("row.*", "sequence_id", "offset")


def sequences(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The packed sequences: ``sequence_id, ids, lengths, keys``, the last two a value per piece in order.

    ``placed`` has the columns of ``cut`` and ``place``. A sequence holds ``capacity`` ids at most, so a group is bounded.
    """
    members = F.sort_array(F.collect_list(F.struct("offset", "length", "ids", F.col(key).alias("key"))))
    return placed.groupBy("sequence_id").agg(members.alias("m")).select(
        "sequence_id",
        F.aggregate("m", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.transform("m", lambda x: x["length"]).alias("lengths"), F.transform("m", lambda x: x["key"]).alias("keys"),
    )
