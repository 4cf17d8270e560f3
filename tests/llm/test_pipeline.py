"""The pipeline, stage by stage, against plain Python over the same input."""

import pytest

import corpus_pipeline
from tallyworks.llm import decontaminate, quality
from tests.conftest import SMALL
from tests.llm.test_lines import by_hand as lines_by_hand
from tests.llm.test_mixing import targets_by_hand
from tests.llm.test_simhash import groups_by_hand, print_by_hand

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def test_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == COLUMNS


def test_rejected_documents_go(spark, results):
    before, after = results[:2]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = quality.score(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).where("keep").collect()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in good)
    texts = {r.doc_id: r for r in before}
    assert all(r == texts[r.doc_id] for r in after)


def test_repeated_lines_go(results):
    before, after = results[1:3]
    assert sorted(((r.doc_id, r.text) for r in after), key=str) == lines_by_hand([(r.doc_id, r.text) for r in before], 50)
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(results):
    before, after = sorted(results[2]), sorted(results[3])
    groups = groups_by_hand([print_by_hand(r.text) for r in before], 2)
    assert [r.doc_id for r in after] == [before[g].doc_id for g in sorted(set(groups))]


def test_contaminated_documents_go(spark, results):
    before, after = results[3:5]
    items = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}

    def clean(text):
        words = decontaminate.words_of(text.encode())
        return not any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))

    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if clean(r.text))
    assert len(after) < len(before)


def test_mix(results):
    before, after = results[4:]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    wanted = targets_by_hand(sizes)
    assert all(r.target == pytest.approx(wanted[r.source]) for r in after)


def test_run_is_the_stages_in_turn(spark, results):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect(), key=str) == sorted(results[-1], key=str)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
