import binascii
import random

import numpy as np
import pytest

from tallyworks.llm import langid
from tallyworks.llm.queries import op3_language_id
from tests.conftest import SMALL


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = op3_language_id(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_mixture_finds_the_proportions():
    random.seed(1)
    model = np.random.default_rng(0).dirichlet(np.full(50, 0.2), size=4).astype(np.float32) + 1e-6
    grams = np.concatenate([random.choices(range(50), model[0], k=700), random.choices(range(50), model[2], k=300)])
    used, counts = np.unique(grams, return_counts=True)
    which, share = langid.mixture(model, used, counts.astype(np.float32))
    assert which.tolist() == [0, 2]
    assert share[0] == pytest.approx(0.7, abs=0.06)


def test_a_short_passage_keeps_its_share():
    """A language with 3 of 1,000 trigrams, seen in no other language, stays; those without a trace go."""
    rng = np.random.default_rng(2)
    model = np.full((5, 50), 1e-7, dtype=np.float32)
    for i in range(5):
        model[i, i * 10 : i * 10 + 10] = rng.dirichlet(np.full(10, 5.0))
    grams = np.concatenate([rng.choice(50, 20_000, p=model[1] / model[1].sum()), rng.choice(50, 60, p=model[3] / model[3].sum())])
    used, counts = np.unique(grams, return_counts=True)
    which, share = langid.mixture(model, used, counts.astype(np.float32))
    assert which.tolist() == [1, 3]
    assert share[1] == pytest.approx(60 / 20_060, rel=0.2)
    only, _ = langid.mixture(model, used[used < 20], counts[used < 20].astype(np.float32))
    assert only.tolist() == [1]


def test_pieces_count_the_same_trigrams(monkeypatch):
    letter = langid.letters()
    text = "Où est là, 12 x; Straße ÀÉ! " * 50
    whole = langid.counted(text, letter)
    monkeypatch.setattr(langid, "PIECE", 10**9)
    assert all((a == b).all() for a, b in zip(whole, langid.counted(text, letter)))
    assert len(langid.counted("12 .,", letter)[0]) == len(langid.counted(None, letter)[0]) == 0


DOCS = "doc_id long, text string, lang string, held_out string, score int"


def test_edges(frame):
    rows = [(i, "der die das und nicht " * 5, "de", "x", 1) for i in range(20)]
    rows += [(i, "the and that with this " * 5, "en", "x", 1) for i in range(20, 40)]
    rows += [(50, None, "en", "x", 1), (51, "12 34 !?", "de", "x", 1), (52, "", None, "x", 1), (None, "und nicht das", None, "x", 1),
             (53, "that with this", None, "x", 1), (53, "that with this", None, "x", 1), (54, "the " * 100_000, None, "x", 1)]
    got = langid.identify(frame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    said = {}
    for r in got:
        said.setdefault(r.doc_id, set()).add(r.lang_pred)
    assert said[50] == said[51] == said[52] == {"und"}
    assert said[None] == {"de"} and said[53] == said[54] == {"en"} and said[3] == {"de"}
    assert all(abs(sum(r.shares.values()) - 1) < 1e-3 for r in got if r.lang_pred != "und")


def test_nothing_to_learn_from_and_empty_table(frame):
    assert langid.identify(frame([], DOCS)).count() == 0
    assert [r.lang_pred for r in langid.identify(frame([(1, "text", None, "", 1)], DOCS)).collect()] == ["und"]


def test_prediction_depends_on_the_text_alone(frame):
    rows = [(i, "der die das" if i % 2 else "the and that", "de" if i % 2 else "en", "", 1) for i in range(30)]
    marked = frame(rows, DOCS)
    names, model = langid.learn(marked)
    other = frame([(99, "the and that", "zz", "", 1), (1, "the and that", None, "", 5)], DOCS).drop("held_out")
    assert {(r.lang_pred, r.score) for r in langid.predict(other, names, model).collect()} == {("en", 1.0)}
