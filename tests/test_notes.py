"""The note classifier: preparation, encoding, models, saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyworks import fixed_values
from tallyworks.operators import aggregates, encode, models
from tallyworks.operators.tfidf import tfidf
from tallyworks.plans import notes
from tallyworks.sources.writers import overwrite_parquet

LIMITS = {"longest": 2, "max_terms": 300}


@pytest.fixture(scope="module")
def prepared(spark, tables, tmp_path_factory):
    # a counted write leaves its mark on the session; models have to work after it
    assert overwrite_parquet(spark.range(3), str(tmp_path_factory.mktemp("write") / "rows")) == 3
    return notes.prepare(tables.raw_notes()).persist()


def test_preparation(frame):
    raw = frame(
        [("A note", "Successful", None, None, None, "20", None, None, None, None),
         ("b", "Unsuccessful", "F", "W", "Low", "x", 2.0, "Felony", 5.0, 3.7),
         ("c", "Transferred", "F", "W", "Low", "30", 2.0, "Felony", 5.0, 3.7),
         (None, "Successful", "F", "W", "Low", "30", 2.0, "Felony", 5.0, 3.7)],
        "Last10Chronos string, CloseType string, Gender string, Race string, Risk string, Age string, arrests_past_year double,"
        "ProbationType string, DaysOnProbation double, EpicsDosagePastYear double",
    )
    rows = notes.prepare(raw, stop_words=["a"]).orderBy("Chronos").collect()
    assert [r.Chronos for r in rows] == ["b", "note"]
    note = rows[1].asDict()
    assert {k: note[k] for k in fixed_values.NOTE_DEFAULTS} == {**fixed_values.NOTE_DEFAULTS}
    assert (rows[0].EpicsDosagePastYear, rows[0].AgeGroup) == (3, 20.0)  # the unreadable age is the mean, 20


def test_one_hot_levels(frame):
    df = frame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    levels = encode.known_levels(df, ["k"])
    assert levels == {"k": ["a", "b"]}
    wide = encode.one_hot(frame([(1, "a"), (2, "z"), (3, None)], "id int, k string"), levels)
    assert [tuple(r) for r in wide.collect()] == [(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 0.0)]


def test_too_many_levels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(encode, "MOST_LEVELS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        encode.known_levels(spark.range(9).select(F.col("id").cast("string").alias("k")), ["k"])


def test_vectors_equal_the_relational_weights(spark, prepared):
    stages = models.text_stages(prepared, "doc_id", "Chronos", **LIMITS)
    vectors = PipelineModel(stages=stages).transform(prepared).select("doc_id", "text_features")
    terms = next(s for s in stages if hasattr(s, "vocabulary")).vocabulary
    weights = {(r.doc_id, r.term): r.weight for r in tfidf(prepared, "doc_id", "Chronos", **LIMITS).collect()}
    seen = 0
    for row in vectors.collect():
        for i, w in zip(row.text_features.indices, row.text_features.values):
            assert w == pytest.approx(weights[row.doc_id, terms[i]], abs=1e-9)
            seen += 1
    assert seen == len(weights)


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 5)) * [1, 5, 0.2, 1, 1]
    y = np.where(x @ [1, -0.3, 2, 0, 0.5] + rng.normal(size=80) > 2.5, 1.0, -1.0)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "_side"])
    model = models.ridge(80, y.std(ddof=1)).fit(df)
    centred = x - x.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(5), centred.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(weights, abs=1e-5)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ weights, abs=1e-5)


@pytest.mark.parametrize("kind, options", [("ridge", {}), ("forest", {"numTrees": 10, "maxDepth": 4}), ("logistic", {"maxIter": 20}), ("svm", {"maxIter": 10})])
def test_hold_out(prepared, kind, options):
    scored = notes.hold_out(prepared, "doc_id", kind, limits=LIMITS, **options)
    assert scored.columns == [*prepared.columns, "Predictions"]
    n = prepared.count()
    rows = scored.select("doc_id", "Outcome", "Predictions").collect()
    assert len({r.doc_id for r in rows}) == len(rows) == -(-3 * n // 10)
    assert {r.Predictions for r in rows} <= {"Successful", "Unsuccessful"}
    assert 0 <= notes.hold_out_accuracy(scored).first().accuracy <= 1


def test_separable_notes_are_learned(frame):
    rows = [(i, f"good steady progress report {i % 7}", "Successful") for i in range(60)]
    rows += [(i, f"missed bad relapse warrant {i % 7}", "Unsuccessful") for i in range(60, 120)]
    df = frame(rows, "doc_id int, Chronos string, Outcome string")
    for c in notes.CATEGORIES:
        df = df.withColumn(c, F.lit("x"))
    for c in notes.NUMBERS:
        df = df.withColumn(c, F.lit(1.0))
    scored = notes.hold_out(df, "doc_id", "ridge", limits={"longest": 2})
    assert notes.hold_out_accuracy(scored).first().accuracy == 1.0


def test_saved_model_scores_the_same_and_accepts_new_levels(spark, prepared, tmp_path):
    model = notes.final_model(prepared, "doc_id", "forest", limits=LIMITS, numTrees=5, maxDepth=3)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    fresh = prepared.withColumn("Gender", F.lit("never seen")).drop("Outcome")
    before = models.score(model, fresh).select("doc_id", "Predictions")
    after = models.score(loaded, fresh).select("doc_id", "Predictions")
    assert before.count() == prepared.count() and before.exceptAll(after).count() == 0


def test_forest_predictions_are_the_votes_of_its_saved_trees(spark, prepared, tmp_path):
    """Every prediction, recomputed in plain Python from the trees that were saved."""
    import numpy as np

    model = notes.final_model(prepared, "doc_id", "forest", limits=LIMITS, numTrees=7, maxDepth=4)
    path = str(tmp_path / "forest")
    forest = model.stages[-2]
    forest.write().overwrite().save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        node = r.nodeData if "nodeData" in r else r
        trees.setdefault(r.treeID, {})[node.id] = node

    def votes(x):
        total = np.zeros(2)
        for nodes in trees.values():
            node = nodes[0]
            while node.leftChild >= 0:
                split = node.split
                if split.numCategories == -1:
                    left = x[split.featureIndex] <= split.leftCategoriesOrThreshold[0]
                else:
                    left = x[split.featureIndex] in split.leftCategoriesOrThreshold
                node = nodes[node.leftChild if left else node.rightChild]
            stats = np.array(node.impurityStats)
            total += stats / stats.sum()
        return total

    assert len(trees) == 7
    rows = model.transform(prepared).select("features", "Predictions").collect()
    sides = set()
    for r in rows:
        bad, good = votes(r.features.toArray())
        if abs(good - bad) > 1e-9:
            assert r.Predictions == ("Successful" if good > bad else "Unsuccessful")
        sides.add(r.Predictions)
    assert len(rows) == prepared.count() and len(sides) == 2


def test_run_writes_scores_and_a_model(spark, tables, tmp_path):
    paths = [str(tmp_path / p) for p in ("scored", "model")]
    rows = notes.run(tables.raw_notes(), "doc_id", *paths, kind="logistic", limits=LIMITS, maxIter=5)
    scored = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths[0])
    assert "Predictions" in scored.columns and rows > 0
    assert PipelineModel.load(paths[1]).stages


def test_flags_name_every_level(frame):
    df = frame([(1, "a", None), (2, "b", "x")], "id int, k string, m string")
    found = sorted(tuple(r) for r in encode.flags(df, "id", ["k", "m"]).collect())
    assert found == [(1, "k_a"), (2, "k_b"), (2, "m_x")]


def test_accuracy(frame):
    df = frame([("a", "a"), ("a", "b"), ("b", "b"), ("b", None)], "label string, p string")
    assert aggregates.accuracy(df, "label", "p").first().accuracy == 0.5


def test_correlations_are_sorted(prepared):
    found = [r.r for r in notes.feature_correlations(prepared).collect() if r.r is not None]
    assert found == sorted(found) and len(found) > 5


def test_encoder_gives_missing_and_unseen_levels_no_flag(frame):
    rows = [(1, "b", "x"), (2, "a", None), (3, "b", "y"), (4, "c", "y"), (5, None, "z")]
    df = frame(rows, "id long, one string, two string")
    got = {(r.id, r.category): (r.level, r.size, r.position) for r in models.encoded(df, "id", ["one", "two"], df.where("id < 4")).collect()}
    assert len(got) == 10
    assert [got[i, "one"] for i in range(1, 6)] == [("b", 2, 1), ("a", 2, 0), ("b", 2, 1), ("c", 2, None), (None, 2, None)]
    assert [got[i, "two"] for i in range(1, 6)] == [("x", 2, 0), (None, 2, None), ("y", 2, 1), ("y", 2, 1), ("z", 2, None)]
