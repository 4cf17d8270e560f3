"""Extra columns named like an operator's own come out as they went in."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyworks.llm import (
    centroids, decontaminate, infill, langid, lines, mixing, neighbours, packing, quality, simhash, substrings, urls,
)
from tests.conftest import SMALL

NAMES = (
    "hits items n_words _raw n_lines n_removed _gone _n _key _hash _row _score _id _text _drawn _source _lang caller row n at one "
    "rank fingerprint component_id _first _root _order _before size source_size taken positions places _tilt _copies "
    "_stretch _sum _offset good score keep lang_pred held_out _turn key unit print place first covers h1 output form "
    "prefix_chars middle_chars sequence_id offset length piece start ids cluster distance lower scans v host path rule "
    "verdict kept_text repeats gram item sums lane words page check name cell part role query id"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.read.parquet(f"{SMALL}/documents.parquet")
    marked = [F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in NAMES if n not in plain.columns]
    return plain.select("*", *marked)


def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def benchmark(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


WHOLE_ROWS = {
    "remove_documents": lambda s, d: decontaminate.remove_documents(d, benchmark(s)),
    "remove_spans": lambda s, d: decontaminate.remove_spans(d, benchmark(s)),
    "deduplicate_lines": lambda s, d: lines.deduplicate_lines(d, counts=False),
    "deduplicate": lambda s, d: simhash.deduplicate(d),
    "filter_good": lambda s, d: quality.filter_good(d, labels(s)),
} | {name: (lambda stage: lambda s, d: stage(s, d, SMALL))(stage) for name, stage in corpus_pipeline.STAGES[:-1]}

OWN_COLUMNS = {
    "scan": (lambda s, d: decontaminate.scan(d, benchmark(s)), {"hits", "items", "n_words"}),
    "deduplicate_lines": (lambda s, d: lines.deduplicate_lines(d), {"n_lines", "n_removed"}),
}

DIGESTS = {
    "flag": lambda s, d: decontaminate.flag(d, benchmark(s)),
    "identify": lambda s, d: langid.identify(d),
    "near_duplicates": lambda s, d: simhash.near_duplicates(d),
    "remove_repeats": lambda s, d: substrings.remove_repeats(d),
    "score": lambda s, d: quality.score(d, labels(s)),
    "mixing": lambda s, d: mixing.plan(d, mixing.cycling_schedule),
    "fill_in_middle": lambda s, d: infill.fill_in_middle(d),
    "cut": lambda s, d: packing.cut(d, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", WHOLE_ROWS)
def test_rows_keep_their_columns(spark, docs, name):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    got = WHOLE_ROWS[name](spark, docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n} {r.doc_id}" for n in NAMES if n not in plain)
    alone = WHOLE_ROWS[name](spark, docs.select(*plain)).collect()
    assert sorted(map(str, (tuple(r[c] for c in plain) for r in rows))) == sorted(map(str, map(tuple, alone)))


@pytest.mark.parametrize("name", OWN_COLUMNS)
def test_own_columns_replace_others_stay(spark, docs, name):
    work, own = OWN_COLUMNS[name]
    rows = work(spark, docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert all(r[n] == f"{n} {r.doc_id}" for n in NAMES if n not in own)
    alone = work(spark, docs.select("doc_id", "text")).collect()
    pick = lambda r: str((r.doc_id, *(r[c] for c in sorted(own))))
    assert sorted(map(pick, rows)) == sorted(map(pick, alone))


@pytest.mark.parametrize("name", DIGESTS)
def test_results_do_not_depend_on_other_columns(spark, docs, name):
    few = docs.select("doc_id", "text", "lang", "source")
    assert sorted(map(str, DIGESTS[name](spark, docs).collect())) == sorted(map(str, DIGESTS[name](spark, few).collect()))


def test_vectors_and_pages(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    more = vectors.select("*", *[F.lit(n).alias(n) for n in NAMES])
    some = more.where("vec_id % 100 = 0")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(neighbours.nearest(more, some), neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")))
    assert same(centroids.cluster(more), centroids.cluster(vectors))
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, action string")
    own = ["page_id", "host", "path", "rule", "verdict"]
    more = pages.select("*", *[F.lit(n).alias(n) for n in NAMES])
    assert same(urls.filter_pages(more, rules).select(*own), urls.filter_pages(pages, rules).select(*own))
