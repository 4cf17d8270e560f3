"""Quality classification by co-training: a view of the text's words and a view of the page's metadata."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from tallyworks.llm.rows import packed, unpacked
from tallyworks.llm.store import save, small_batches

#: Labelled rows the classifiers are fitted on. Unlabelled rows teach them all.
LABELLED_ROWS = 6_000

#: Features of the text view; rounds of exchange; how sure a view must be to hand on a label.
VOCABULARY, ROUNDS, SURE = 4_000, 2, 0.98

#: Gradient steps of a round, each a pass over the features of all unlabelled documents.
PASSES = 16

#: Gradients are added up in whole multiples of this: sums don't depend on how rows are dealt.
GRAIN = 2.0**-20

#: Sums of the tasks are added up in so many rows at most before they go to the driver.
LANES = 64

#: A document is kept if the combined views give it at least this probability of being good.
THRESHOLD = 0.5

#: Bytes that are not part of a word, as blanks.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
MARKS = re.compile(rb"[!-/:-@\[-`{-~]{2,}|(?<!\S)\S(?!\S)")
UPPER, DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))
MARK_BYTES = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def content(text: bytes | None) -> set[bytes]:
    """Text view: distinct words in lower case, their first four bytes, runs of marks, lone characters."""
    raw = text or b""
    words = set(raw.lower().translate(LETTERS).split())
    starts = {b"^" + w[:4] for w in words if len(w) > 4}
    return words | starts | {b"#" + m for m in set(MARKS.findall(raw))}


def metadata(text: bytes | None, source: str | None, lang: str | None) -> tuple[list[str], list[float]]:
    """Page view: what is known of the document without its words. Names, and measures of its shape."""
    raw = text or b""
    words = raw.split()
    size, n = max(1, len(raw)), max(1, len(words))
    measures = [
        np.log1p(len(raw)),
        np.log1p(raw.count(b"\n") * 1000 / size),
        (size - len(raw.translate(None, UPPER))) / size,
        (size - len(raw.translate(None, DIGITS))) / size,
        (size - len(raw.translate(None, MARK_BYTES))) / size,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(raw) / n,
    ]
    return [f"source={source}", f"lang={lang}"], [float(m) for m in measures]


class Sparse:
    """A 0/1 matrix given by the features of each row."""

    def __init__(self, rows: list[list[int]], width: int):
        self.width = width
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.columns = np.fromiter((c for r in rows for c in r), dtype=np.int64, count=int(self.lengths.sum()))
        self.rows = np.repeat(np.arange(len(rows)), self.lengths)

    @classmethod
    def of(cls, lists: pa.ListArray, width: int) -> Sparse:
        made = cls([], width)
        made.lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        made.columns = lists.flatten().to_numpy(zero_copy_only=False)
        made.rows = np.repeat(np.arange(len(lists)), made.lengths)
        return made

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=w[self.columns], minlength=len(self.lengths))

    def gathered(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, weights=r[self.rows], minlength=self.width)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: Sparse, y: np.ndarray, penalty: float = 1.0, steps: int = 150) -> np.ndarray:
    """Ridge-penalised logistic regression; the last weight is the intercept. Accelerated gradient steps,
    scaled for every feature by a bound on the curvature."""
    w = np.zeros(x.width + 1)
    before = w
    scale = np.r_[0.25 * x.gathered(x.lengths.astype(float) + 1) + penalty, 0.25 * (x.lengths + 1).sum() + 1e-9]
    for t in range(steps):
        ahead = w + (w - before) * t / (t + 3)
        r = sigmoid(x.times(ahead[:-1]) + ahead[-1]) - y
        gradient = np.r_[x.gathered(r) + penalty * ahead[:-1], r.sum()]
        before, w = w, ahead - gradient / scale
    return w


def drawn_logistic(x: np.ndarray, t: np.ndarray, start: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Logistic regression on a few columns, drawn towards ``start``: Newton steps, halved until the loss falls,
    so that it ends on separable data too."""

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - t * z).sum() + 0.5 * (ridge * (w - start) ** 2).sum()

    w, now = start, loss(start)
    for _ in range(50):
        p = sigmoid(x @ w)
        hessian = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (p - t) + ridge * (w - start))
        while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if new >= now - 1e-10:
            break
        w, now = w - step, new
    return w


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into calibrated log-odds; targets are drawn in a little."""
    good = y.sum()
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    a, b = drawn_logistic(np.c_[score, np.ones(len(y))], t, np.array([1.0, 0.0]), np.array([1.0, 0.01]))
    return float(a), float(b)


class View:
    """One classifier: which features it knows, their weights, its calibration."""

    def __init__(self, number: dict, bins: list[np.ndarray] | None = None):
        self.number, self.bins = number, bins
        self.weights, self.calibration = np.zeros(len(number) + 1), (1.0, 0.0)

    def features(self, item) -> list[int]:
        if self.bins is None:
            names = item
        else:
            names = item[0] + [f"{i}:{np.searchsorted(b, m)}" for i, (b, m) in enumerate(zip(self.bins, item[1]))]
        return [self.number[f] for f in names if f in self.number]

    def fit(self, rows: list[list[int]], y: np.ndarray):
        self.weights = logistic(Sparse(rows, len(self.number)), y)

    def score(self, rows: list[list[int]]) -> np.ndarray:
        return Sparse(rows, len(self.number)).times(self.weights[:-1]) + self.weights[-1]

    def log_odds(self, rows: list[list[int]]) -> np.ndarray:
        a, b = self.calibration
        return a * self.score(rows) + b


def vocabulary(rows: DataFrame) -> list[bytes]:
    """The features that tell good from bad best, by chi-squared, among those of three documents at least.

    ``rows`` has ``words`` and ``good``. Counting is done by Spark; ``VOCABULARY`` names come back.
    """
    share = rows.agg(F.avg(F.col("good").cast("double"))).scalar()
    counts = rows.select(F.explode("words").alias("word"), F.col("good").cast("double").alias("good"))
    counts = counts.groupBy("word").agg(F.count("*").alias("n"), F.sum("good").alias("good")).where("n >= 3")
    gap = F.col("good") - F.col("n") * share
    strength = F.try_divide(gap * gap, F.col("n") * share * (1 - share))
    best = counts.orderBy(F.desc_nulls_last(F.round(strength, 6)), "word").limit(VOCABULARY)
    return sorted(bytes(r.word) for r in best.select("word").collect())


def page_view(items: list[tuple]) -> View:
    """Names as they are, measures by tenths."""
    measures = np.array([m for _, m in items])
    bins = [np.unique(np.quantile(column, np.arange(1, 10) / 10)) for column in measures.T]
    names = sorted({n for name, _ in items for n in name})
    names += [f"{i}:{j}" for i, b in enumerate(bins) for j in range(len(b) + 1)]
    return View({name: i for i, name in enumerate(names)}, bins)


def class_sums(unlabelled: DataFrame, widths: list[int], frozen: list, ahead: list, curved: bool) -> list[list[dict]]:
    """For each view and class (bad, good), sums over all documents that the other view, as ``frozen``, is sure are
    of that class: the gradient at the weights ``ahead`` and, if ``curved``, a bound on the curvature and the count."""

    def summing(batches):
        total = np.zeros(0)
        for batch in batches:
            x = [Sparse.of(batch.column(c), width) for c, width in zip(("words", "page"), widths)]
            part = []
            for i, own in enumerate(x):
                w, (a, b) = frozen[1 - i]
                p = sigmoid(a * (x[1 - i].times(w[:-1]) + w[-1]) + b)
                now = sigmoid(own.times(ahead[i][:-1]) + ahead[i][-1])
                for label, sure in ((0, p < 1 - SURE), (1, p > SURE)):
                    r = np.where(sure, np.round((now - label) / GRAIN), 0.0)
                    part += [own.gathered(r), [r.sum()]]
                    if curved:
                        n = np.where(sure, own.lengths + 1.0, 0.0)
                        part += [own.gathered(n), [n.sum()], [sure.sum()]]
            total = np.concatenate(part) + (total if total.size else 0.0)
        if total.size:
            lane = pa.array([TaskContext.get().partitionId() % LANES])
            yield pa.RecordBatch.from_arrays([lane, pa.array([total.tobytes()], pa.binary())], names=["lane", "sums"])

    size = sum(2 * (2 * (width + 1) + 1 if curved else width + 1) for width in widths)
    total = np.zeros(size)
    for row in added_up(unlabelled.mapInArrow(summing, "lane long, sums binary")).collect():
        total += np.frombuffer(row["sums"])
    out, at = [], 0
    for width in widths:
        out.append([])
        for _ in range(2):
            found = {"gradient": total[at : at + width + 1] * GRAIN}
            at += width + 1
            if curved:
                found |= {"curvature": total[at : at + width + 1], "n": total[at + width + 1]}
                at += width + 2
            out[-1].append(found)
    return out


def added_up(sums: DataFrame) -> DataFrame:
    """Rows ``lane, sums`` added up by Spark: ``LANES`` rows at most, however many tasks there were.

    Sums are whole numbers that a double holds, so it does not matter in which order they are added.
    """

    def adding(batches):
        total = np.zeros(0)
        for batch in batches:
            for value in batch.column("sums"):
                total = np.frombuffer(value.as_buffer()) + (total if total.size else 0.0)
        if total.size:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return sums.repartition("lane").mapInArrow(adding, "sums binary")


def learn_further(views: list[View], known: list[Sparse], y: np.ndarray, unlabelled: DataFrame, penalty: float = 1.0):
    """A round of exchange: each view goes on learning from its labelled rows and every document of which the other is sure.

    Together these documents weigh as much as the labelled rows at most, shared by class as the labels are, and none
    weighs more than a labelled row. What a class with few or none of them lacks goes to its labelled rows, so
    the classes stay in proportion. Steps as in ``logistic``, from the weights so far.
    """
    frozen = [(v.weights, v.calibration) for v in views]
    now = [v.weights for v in views]
    before, widths = now, [x.width for x in known]
    rows, shares, scales = [], [], []
    for t in range(PASSES):
        ahead = [w + (w - old) * t / (t + 3) for w, old in zip(now, before)]
        sums = class_sums(unlabelled, widths, frozen, ahead, t == 0)
        for x, found in zip(known, sums if t == 0 else []):
            many = min(sum(f["n"] for f in found), len(y))
            wanted = [many * (1 - y.mean()), many * y.mean()]
            share = [min(1.0, want / f["n"]) if f["n"] else 0.0 for want, f in zip(wanted, found)]
            lacks = [want - part * f["n"] for want, part, f in zip(wanted, share, found)]
            own = 1 + np.where(y > 0, lacks[1] / y.sum(), lacks[0] / (len(y) - y.sum()))
            spread = own * (x.lengths + 1)
            curvature = np.r_[x.gathered(spread), spread.sum()] + sum(a * f["curvature"] for a, f in zip(share, found))
            rows.append(own)
            shares.append(share)
            scales.append(0.25 * curvature + np.r_[np.full(x.width, penalty), 1e-9])
        after = []
        for x, own, share, scale, w, found in zip(known, rows, shares, scales, ahead, sums):
            r = own * (sigmoid(x.times(w[:-1]) + w[-1]) - y)
            gradient = np.r_[x.gathered(r) + penalty * w[:-1], r.sum()]
            after.append(w - (gradient + sum(a * f["gradient"] for a, f in zip(share, found))) / scale)
        before, now = now, after
    for view, w in zip(views, now):
        view.weights = w


def co_train(words: View, labelled: list[tuple], features_of_rest) -> tuple[View, View, np.ndarray] | None:
    """Fit both views on labelled rows ``(word features, metadata, good, check)`` and all unlabelled documents, whose
    feature numbers ``features_of_rest(page view)`` gives as a table (``words``, ``page``).

    In every round each view labels the documents of which it is sure, anew among all unlabelled ones, and
    the other view learns from every one of them. Labelled rows marked
    ``check`` only calibrate: first each view, then the weights by which their log-odds are
    combined. None without rows of both classes.
    """
    y = np.array([r[2] for r in labelled], dtype=float)
    if len(y) < 8 or not 0 < y.sum() < len(y):
        return None
    learn = np.array([not r[3] for r in labelled], dtype=bool)
    if not 0 < y[learn].sum() < learn.sum() or not 0 < y[~learn].sum() < (~learn).sum():
        learn = np.ones(len(y), dtype=bool)
    check = ~learn if not learn.all() else learn
    page = page_view([r[1] for r, use in zip(labelled, learn) if use])
    views = [words, page]
    known = [[r[0] for r in labelled], [page.features(r[1]) for r in labelled]]
    pick = lambda rows, which: [rows[i] for i in np.flatnonzero(which)]
    for view, rows in zip(views, known):
        view.fit(pick(rows, learn), y[learn])
    unlabelled = features_of_rest(page)
    own = [Sparse(pick(rows, learn), len(view.number)) for view, rows in zip(views, known)]
    for turn in range(ROUNDS + 1):
        for view, rows in zip(views, known):
            view.calibration = platt(view.score(pick(rows, check)), y[check])
        if turn < ROUNDS:
            learn_further(views, own, y[learn], unlabelled)
    odds = np.stack([v.log_odds(pick(known[i], check)) for i, v in enumerate(views)], axis=1)
    return words, page, stacked(odds, y[check])


def stacked(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the views' log-odds and an offset, drawn towards equal halves."""
    return drawn_logistic(np.c_[odds, np.ones(len(y))], y, np.array([0.5, 0.5, 0.0]), np.ones(3))


def _views(docs: DataFrame, *carry: str) -> DataFrame:
    """What both views are made from: the raw text, source and language, null where a table has none."""
    wanted = [
        (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(f"_{c}")
        for c in ("source", "lang")
    ]
    return small_batches(docs).select(*carry, F.col("text").cast("binary").alias("_raw"), *wanted)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, score, keep)`` for every row: the probability that a document is good, and whether it stays.

    ``labels`` has ``key``, ``quality`` and ``toxic``: good is quality 1 and not toxic; a null label is no label, and
    of contradicting labels of a key the worse counts. The two classifiers are fitted on
    at most about ``LABELLED_ROWS`` labelled documents, picked by a hash of their key, and on all unlabelled ones.
    Spark makes their features and picks the vocabulary; the driver gets the feature numbers of labelled ones and,
    for all others, sums per task. Every document is scored, with its whole text. Null and empty texts are scored by
    their metadata, texts of any length whole. Rows that share a key are drawn and scored one by one; a repeated row teaches once. Documents
    on a tie of both classes stay (``THRESHOLD`` and above). Without labels of both classes everything stays, with score 1.
    """
    used = [c for c in docs.columns if c in (key, "text", "source", "lang")]
    scored = _scored(docs.select(*used), labels, key, [key])
    return scored.select(key, F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).alias("keep"))


def _scored(docs: DataFrame, labels: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of every row, and ``_score``."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    judged = labels.where("quality is not null and toxic is not null").groupBy(F.col(key).alias("_id")).agg(
        F.min(good).alias("good")
    )
    place = F.pmod(F.xxhash64(key, "_text", F.lit(1)), F.lit(1 << 20))
    texts = F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_text")
    ids = docs.select(key, texts).where(F.col(key).isNotNull())
    tagged = ids.join(judged, ids[key] == judged["_id"]).groupBy(key, "_text").agg(F.min("good").alias("good"))
    tagged = save(tagged, "tagged")
    share = min(1.0, LABELLED_ROWS / max(1, tagged.count()))
    drawn = tagged.where(place < int(share * (1 << 20))).withColumnRenamed(key, "_id")
    # rows, not keys, are drawn, and a repeated row is one: what goes to the driver is bounded
    rows = docs.select("*", texts).join(
        F.broadcast(drawn.withColumnRenamed("_text", "_drawn")), (F.col(key) == F.col("_id")) & (F.col("_text") == F.col("_drawn"))
    ).dropDuplicates([key, "_text"])
    if rows.limit(1).count() == 0:
        return docs.select(*carry, F.lit(1.0).alias("_score"))
    sample = _views(rows.select(*docs.columns), key)
    told = drawn.select("_id", "good").distinct()

    def featured(batches):
        for batch in batches:
            words, names, measures = [], [], []
            for raw, source, lang in zip(*(batch.column(c).to_pylist() for c in ("_raw", "_source", "_lang"))):
                words.append(sorted(content(raw)))
                name, measure = metadata(raw, source, lang)
                names.append(name)
                measures.append(measure)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(words, pa.list_(pa.binary())), pa.array(names, pa.list_(pa.string())),
                 pa.array(measures, pa.list_(pa.float64()))],
                names=[key, "words", "names", "measures"],
            )

    schema = sample.select(key).schema.add("words", ArrayType(BinaryType())).add("names", ArrayType(StringType()))
    made = sample.mapInArrow(featured, schema.add("measures", ArrayType(DoubleType())))
    check = F.pmod(F.xxhash64(key, F.lit(2)), F.lit(4)) == 3
    made = save(
        made.join(F.broadcast(told), F.col(key) == F.col("_id")).withColumn("check", check).drop("_id"), "features"
    )
    names = vocabulary(made.where("not check"))
    words = View({name: i for i, name in enumerate(names)})

    def numbered(batches):
        for batch in batches:
            found = [words.features(map(bytes, row)) for row in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                 *(batch.column(c) for c in ("names", "measures", "good", "check"))],
                names=["words", "names", "measures", "good", "check"],
            )

    columns = ["words", "names", "measures", "good", "check"]
    kinds = StructType([StructField("words", ArrayType(LongType()))] + [made.schema[c] for c in columns[1:]])
    fitted = made.select(*columns).mapInArrow(numbered, kinds).collect()
    fitted.sort(key=lambda r: (r["measures"], r["words"], r["names"], str(r["good"]), r["check"]))

    def features_of_rest(page: View) -> DataFrame:
        """Feature numbers of all documents without a label; texts stay where they are."""
        known = [(v.number, v.bins) for v in (words, page)]

        def numbering(batches):
            views = [View(*v) for v in known]
            for batch in batches:
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("_raw", "_source", "_lang"))))
                found = [
                    [sorted(views[0].features(content(raw))) for raw, *_ in rows],
                    [sorted(views[1].features(metadata(*row))) for row in rows],
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), *(pa.array(f, pa.list_(pa.int32())) for f in found)], names=[key, "words", "page"]
                )

        kinds = docs.select(key).schema.add("words", ArrayType(IntegerType())).add("page", ArrayType(IntegerType()))
        numbers = _views(docs, key).mapInArrow(numbering, kinds)
        return save(numbers.join(judged, F.col(key) == F.col("_id"), "left_anti").select("words", "page"), "unlabelled")

    model = co_train(
        words, [(r["words"], (r["names"], r["measures"]), r["good"], r["check"]) for r in fitted], features_of_rest
    )
    if model is None:
        return docs.select(*carry, F.lit(1.0).alias("_score"))
    words, page, weights = model
    # plain numbers for the workers
    plain = docs.sparkSession.sparkContext.broadcast(
        [(v.number, v.bins, v.weights, v.calibration) for v in (words, page)]
    )

    def scoring(batches):
        views = []
        for number, bins, w, calibration in plain.value:
            view = View(number, bins)
            view.weights, view.calibration = w, calibration
            views.append(view)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("_raw", "_source", "_lang"))))
            odds = [
                views[0].log_odds([views[0].features(content(raw)) for raw, *_ in rows]),
                views[1].log_odds([views[1].features(metadata(*row)) for row in rows]),
            ]
            p = sigmoid(np.stack([*odds, np.ones(len(rows))], axis=1) @ weights)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(p)], names=[*carry, "_score"])

    return _views(docs, *carry).mapInArrow(scoring, docs.select(*carry).schema.add("_score", "double"))


def filter_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps. Texts are scored and filtered where they are, without a shuffle."""
    used = [c for c in docs.columns if c in (key, "text", "source", "lang")]
    rows = packed(docs, *used)
    return _scored(rows, labels, key, rows.columns).where(F.col("_score") >= THRESHOLD).select(*unpacked(docs, *used))
