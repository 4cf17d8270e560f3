import functools
import random
import zlib
from bisect import bisect_left, insort
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm import packing
from tallyworks.llm.queries import op11_best_fit_packing
from tests.conftest import SMALL

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def ids_by_hand(path, texts, end=0):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def pieces_by_hand(keys, whole, capacity):
    out = []
    for key, ids in zip(keys, whole):
        for n, start in enumerate(range(0, len(ids), capacity)):
            out.append((key, n, start, ids[start : start + capacity]))
    return out


def best_fit(lengths, capacity):
    """How many bins plain best-fit decreasing needs."""
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        if at < len(gaps):
            gap = gaps.pop(at) - n
        else:
            bins, gap = bins + 1, capacity - n
        insort(gaps, gap)
    return bins


def check_places(rows, capacity):
    """Every sequence is filled from 0 on without gaps, within its capacity; sequences are numbered without gaps."""
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(at) == list(range(len(at)))
    return len(at)


def test_query_on_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = op11_best_fit_packing(spark, SMALL).collect()
    wanted = pieces_by_hand([r.doc_id for r in docs], ids_by_hand(WORDS, [r.text for r in docs]), 2048)
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(
        (k, n, s, len(i), crc(i)) for k, n, s, i in wanted
    )
    bins = check_places(got, 2048)
    lengths = [r.length for r in got]
    assert bins <= best_fit(lengths, 2048)
    assert bins >= -(-sum(lengths) // 2048)


ODD = [
    None, "", " ", "\n\t ", "Hello, WORLD's 123 it's 'sun '' don't!?", "</w> <|endoftext|>x", "a\x00b\x0b\x0cc\x1cd\x7fe\x85f\xa0g",
    "ΟΔΟΣ Σ ΣΑ İstanbul ß ﬁ", "é ́e ñ", "文字列 を 分ける 🙂🙂", "x" * 5000, "ab1" * 3000 + " tail", "1 22 333 a1b2",
    "word " * 9000,
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_equal_the_tokenizer(frame, path):
    rows = [(i, t, 1, "x") for i, t in enumerate(ODD)] + [(4, ODD[4], 1, "x"), (None, "null key", 2, "y")]
    df = frame(rows, "doc_id long, text string, _text int, rank string")
    got = packing.cut(df, path, capacity=100).collect()
    wanted = pieces_by_hand([r[0] for r in rows], ids_by_hand(path, [r[1] for r in rows]), 100)
    ours = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert sorted(ours, key=str) == sorted(wanted, key=str)
    assert all(r.length == len(r.ids) // 4 for r in got)


def test_every_plain_character(frame):
    plain = [chr(c) for c in range(33, 0x250)]
    texts = [f"a{c}b {c}{c} {c}'s {c}\u0301 X{c}1é{c.upper()}" for c in plain] + ["".join(plain)]
    encoder = packing.Encoder(Path(WORDS).read_text())
    assert [np.frombuffer(encoder.ids(t), "<u4").tolist() + [0] for t in texts] == ids_by_hand(WORDS, texts)


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="aAzé ÉßÀ\u0301ÿ¿×÷µª'sST1.²", max_size=30))
def test_ids_of_any_run(text):
    encoder = packing.Encoder(definition_of_words())
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() + [0] == ids_by_hand(WORDS, [text])[0]


@functools.cache
def definition_of_words():
    return Path(WORDS).read_text()


def test_memory_of_runs_is_emptied(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = packing.Encoder(Path(WORDS).read_text())
    assert encoder.by_runs
    random.seed(5)
    texts = [" ".join(random.choice("abXYé.,'s") * random.randint(1, 90) for _ in range(40)) for _ in range(60)]
    assert [np.frombuffer(encoder.ids(t), "<u4").tolist() + [0] for t in texts] == ids_by_hand(WORDS, texts)
    assert max(map(len, [*encoder.runs, *encoder.parts])) <= packing.REMEMBERED_CHARS
    assert not packing.Encoder(Path(BYTES).read_text()).by_runs


@pytest.mark.parametrize("seed", range(6))
def test_bins_are_as_few_as_best_fit_needs(seed):
    random.seed(seed)
    for _ in range(30):
        capacity = random.choice([1, 2, 3, 10, 97, 512])
        top = random.choice([capacity, capacity, max(1, capacity // 2), max(1, capacity // 7)])
        lengths = [random.randint(1, top) for _ in range(random.choice([1, 3, 50, 900]))]
        if random.random() < 0.5:
            lengths += [random.choice(lengths)] * 300
        counts = {n: lengths.count(n) for n in set(lengths)}
        bins = packing.plan_bins(counts, capacity)
        used = {}
        for number, contents in bins:
            assert sum(n * each for n, each in contents) <= capacity
            assert sum(each for n, each in contents if 3 * n > capacity) <= 2
            for n, each in contents:
                used[n] = used.get(n, 0) + number * each
        assert used == counts
        total = sum(number for number, _ in bins)
        assert -(-sum(lengths) // capacity) <= total <= best_fit(lengths, capacity)


def test_plan_depends_on_lengths_not_on_items():
    counts = {n: 10**12 + n for n in range(1, 2049)}
    bins = packing.plan_bins(counts, 2048)
    slots = packing._slots(bins)
    assert sum(len(c[0]) for c in slots.values()) < 20_000
    used = {}
    for number, contents in bins:
        for n, each in contents:
            used[n] = used.get(n, 0) + number * each
    assert used == counts


def test_places(spark):
    random.seed(3)
    lengths = [random.choice([100, 40, 33, random.randint(1, 100)]) for _ in range(3000)] + [7] * 2000
    df = spark.createDataFrame([(n, i, 5, "r", i % 9) for i, n in enumerate(lengths)],
                               "length int, id int, offset int, row string, n int").repartition(7)
    got = packing.place(df, capacity=100)
    assert got.columns == ["length", "id", "row", "n", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r.length, r.id, r.row, r.n) for r in rows) == sorted((n, i, "r", i % 9) for i, n in enumerate(lengths))
    assert check_places(rows, 100) <= best_fit(lengths, 100)


def test_empty_and_wrong_lengths(frame):
    assert packing.place(frame([], "length long")).count() == 0
    empty = packing.cut(frame([], "doc_id long, text string"), WORDS)
    assert packing.sequences(packing.place(empty)).count() == 0
    for n in (0, None, 2049):
        with pytest.raises(ValueError):
            packing.place(frame([(n,)], "length long"))


def test_sequences_hold_the_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = packing.cut(docs, WORDS, capacity=512)
    made = packing.sequences(packing.place(pieces, capacity=512)).collect()
    whole = {}
    for r in made:
        ids, at = np.frombuffer(r.ids, "<u4").tolist(), 0
        assert len(ids) == sum(r.lengths) <= 512
        for key, n in zip(r["keys"], r.lengths):
            whole.setdefault(key, []).append(ids[at : at + n])
            at += n
    rows = docs.collect()
    for r, ids in zip(rows, ids_by_hand(WORDS, [r.text for r in rows])):
        parts = [ids[s : s + 512] for s in range(0, len(ids), 512)]
        assert sorted(whole[r.doc_id]) == sorted(parts)
    assert pieces.agg(F.count("*")).first()[0] == sum(map(len, whole.values()))
