"""Every query as a function of the session and a data folder.

Floating-point results are rounded: sums of doubles depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyworks import schemas
from tallyworks.bindings import Tables
from tallyworks.functions import nested, nulls, recode, text
from tallyworks.operators import (
    aggregates, chi_square, correlation, density, encode, models, pulls, quantiles, ranking, tfidf,
)
from tallyworks.plans import meets, notes, quotes, shop, study, video
from tallyworks.session import cut_lineage, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Stop words of the registered stop-word query.
SHORT_STOP_LIST = ["the", "and", "of", "in", "is", "der", "die", "und", "le", "la", "et", "el", "los"]
#: Age classes of the order priorities, youngest first, with one never seen.
PRIORITY_LEVELS = ["0-NONE", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
#: Number and truth columns of prepared meet results.
RESULT_NUMBERS = [
    "Tested", "BodyweightKg", "Best3SquatKg", "Best3BenchKg", "Best3DeadliftKg", "TotalKg",
    "FailedAttempts", "SquatRatio", "BenchRatio", "DeadliftRatio", "Year",
]


def query(name: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables as a query."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        return build

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round computed doubles; adding 0.0 makes a negative zero positive."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in columns})


def results(t: Tables) -> DataFrame:
    return meets.prepare_results(t.raw_results(), PRIORITY_LEVELS)


def cases(t: Tables) -> DataFrame:
    return study.study(t.raw_decisions())


# --- scans, projections and filters ----------------------------------------------


@query("scan_parquet")
def scan_parquet(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").filter(F.col("l_quantity") >= 25)


@query("project_subset")
def project_subset(t):
    wide = t.customer.drop("c_acctbal", "c_nationkey")
    return wide.select("c_custkey", "c_name", "c_mktsegment").withColumnsRenamed(
        {"c_custkey": "customer", "c_mktsegment": "segment"}
    )


@query("filter_eq")
def filter_eq(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("filter_null_safe_ne")
def filter_null_safe_ne(t):
    """Rows whose federation is not A, those without one included."""
    line = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("federation")
    )
    return line.filter(nulls.differs("federation", "A"))


@query("filter_and_or")
def filter_and_or(t):
    line = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_linestatus", F.nullif("l_quantity", F.lit(1.0)).alias("quantity"), "l_returnflag"
    )
    either = (F.col("l_returnflag") == "R") | (F.col("l_returnflag") == "A")
    return line.filter(either & F.col("quantity").isNotNull()).select("l_orderkey", "l_linenumber", "quantity")


@query("filter_isin")
def filter_isin(t):
    return t.part.filter(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey", "p_type")


@query("cast_schema")
def cast_schema(t):
    target = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("cmc_rank", T.ShortType()),
            T.StructField("price", T.FloatType()),
        ]
    )
    flat = t.events.select(
        "event_id",
        (F.col("event_id") * 1_000_000).alias("id"),
        F.get_json_object("props", "$.k").alias("cmc_rank"),
        F.col("value").alias("price"),
    )
    narrow = flat.select("event_id", *recode.cast_to(target))
    return rounded(
        narrow.select("event_id", "id", F.col("cmc_rank").cast("int").alias("cmc_rank"), F.col("price").cast("double").alias("price")),
        4, "price",
    )


# --- video watching -------------------------------------------------------------


@query("top_k_per_group")
def top_k_per_group(t):
    return video.top_videos_by_type(t.plays(), t.videos())


@query("watch_time_by_video")
def watch_time_by_video(t):
    return video.watch_time_by_video(t.plays())


@query("viewer_totals")
def viewer_totals(t):
    return video.viewer_totals(t.views())


@query("viewer_totals_merged")
def viewer_totals_merged(t):
    """As ``viewer_totals``, from the stored summaries of three pulls."""
    views = written(t.views(), "views")  # joined once, not for each pull
    parts = [views.filter(F.pmod(F.floor("watch_time_minutes"), F.lit(3)) == i) for i in range(3)]
    stored = [written(pulls.summarise(p, ["viewer_id"], "video_id", "watch_time_minutes"), "pull") for p in parts]
    summaries = stored[0].unionByName(stored[1]).unionByName(stored[2])
    return pulls.totals(summaries, ["viewer_id"], "total_watch_time", "total_unique_videos_watched")


@query("quartiles_over_pulls")
def quartiles_over_pulls(t):
    """Quartiles by group from the stored sketches of three pulls: rows counted, and whether each is within its rank error."""
    facts = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("double").alias("price"))
    keys = ["l_returnflag", "l_linestatus"]
    parts = [facts.filter(F.pmod("l_orderkey", F.lit(3)) == i) for i in range(3)]
    stored = [written(pulls.sketched(p, keys, ["price"]), "pull") for p in parts]
    answers = pulls.quantiles(stored[0].unionByName(stored[1]).unionByName(stored[2]), keys, quantiles.QUARTILES)
    met = facts.join(F.broadcast(answers), keys)
    error = F.lit(pulls.RANK_ERROR)

    def within(name, share):
        below = F.count_if(F.col("price") < F.col(f"`{name}`")) / F.count(F.lit(1))
        up_to = F.count_if(F.col("price") <= F.col(f"`{name}`")) / F.count(F.lit(1))
        return ((below <= share + error) & (up_to >= share - error)).alias(name)

    return met.groupBy(*keys).agg(F.first("n").alias("n"), *[within(n, s) for n, s in quantiles.QUARTILES.items()])


@query("top_viewers_by_time")
def top_viewers_by_time(t):
    return video.top_viewers(t.views(), "total_watch_time")


@query("top_viewers_by_videos")
def top_viewers_by_videos(t):
    return video.top_viewers(t.views(), "total_unique_videos_watched")


@query("country_watch_time")
def country_watch_time(t):
    return video.watch_time_by_country(t.views(), t.viewers(), t.countries())


@query("video_viewers_vs_watch")
def video_viewers_vs_watch(t):
    return rounded(video.watch_time_by_audience(t.views(), t.videos()), 4, "average_total_watch_time")


@query("avg_watch_by_video")
def avg_watch_by_video(t):
    return rounded(video.mean_watch_by_video(t.plays(), t.videos()), 4, "average_watch_time")


@query("avg_watch_by_video_integer")
def avg_watch_by_video_integer(t):
    return video.mean_watch_by_video(t.plays(), t.videos(), integer=True)


@query("avg_watch_overall")
def avg_watch_overall(t):
    return rounded(video.mean_watch(t.plays()), 4, "average_watch_time")


@query("genre_watch_time")
def genre_watch_time(t):
    return video.watch_time_by_genre(t.plays(), t.videos())


@query("genre_video_count")
def genre_video_count(t):
    return video.videos_by_genre(t.videos())


# --- meet results ---------------------------------------------------------------


@query("count_negatives")
def count_negatives(t):
    return results(t).groupBy("Name", "FailedAttempts").agg(F.count(F.lit(1)).alias("n"))


@query("clamp_negative")
def clamp_negative(t):
    return t.customer.select(
        "c_custkey", nulls.clamp_negative(F.nullif("c_acctbal", F.lit(0.0))).alias("balance")
    )


@query("safe_ratio")
def safe_ratio(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    ratio = nulls.safe_ratio("o_totalprice", F.greatest(F.col("c_acctbal"), F.lit(0.0)))
    return rounded(joined.select("o_orderkey", ratio.alias("ratio")), 6, "ratio")


@query("meets")
def meets_table(t):
    return meets.meets(results(t))


@query("meet_means")
def meet_means(t):
    return rounded(meets.meet_means(meets.meets(results(t))), 4, "Participants", "FailedAttempts")


@query("top_federations")
def top_federations(t):
    return meets.top_federations(results(t))


@query("top_meet_countries")
def top_meet_countries(t):
    return meets.top_meet_countries(meets.meets(results(t)))


@query("meets_per_year")
def meets_per_year(t):
    return meets.meets_per_year(meets.meets(results(t)), except_year=2001)


@query("participants_per_year")
def participants_per_year(t):
    return meets.participants_per_year(results(t), male="MACHINERY", except_year=2001)


@query("value_counts")
def value_counts(t):
    return aggregates.value_counts(results(t), "Federation")


@query("value_counts_ordered")
def value_counts_ordered(t):
    return aggregates.counts_by_level(results(t), "AgeClass", PRIORITY_LEVELS)


@query("group_means")
def group_means(t):
    return rounded(aggregates.means_by(results(t), "Sex", RESULT_NUMBERS), 4, *RESULT_NUMBERS)


@query("group_means_tested")
def group_means_tested(t):
    columns = [c for c in RESULT_NUMBERS if c != "Tested"]
    return rounded(aggregates.means_by(results(t), "Tested", columns), 4, *columns)


@query("group_means_equipment")
def group_means_equipment(t):
    return rounded(aggregates.means_by(results(t), "Equipment", RESULT_NUMBERS), 4, *RESULT_NUMBERS)


@query("group_means_ordered")
def group_means_ordered(t):
    means = aggregates.means_by_level(results(t), "AgeClass", PRIORITY_LEVELS, RESULT_NUMBERS)
    return rounded(means, 4, *RESULT_NUMBERS)


@query("null_profile")
def null_profile(t):
    return aggregates.null_profile(results(t).select("Name", "AgeClass", "Federation", "ParentFederation", "Best3BenchKg", "SquatRatio"))


@query("describe")
def describe(t):
    columns = [c for c in RESULT_NUMBERS if c != "Tested"]
    stats = quantiles.describe(results(t), columns)
    return rounded(stats, 4, "mean", "std", "min", "25%", "50%", "75%", "max")


@query("corr_matrix")
def corr_matrix(t):
    return rounded(correlation.correlation_matrix(results(t), RESULT_NUMBERS), 6, "r")


@query("histogram")
def histogram(t):
    return density.histogram(results(t), "FailedAttempts", 1)


@query("density_2d")
def density_2d(t):
    return density.density_2d(results(t), ["Sex"], "BodyweightKg", "Best3DeadliftKg", 500, 5_000)


@query("density_2d_lifts")
def density_2d_lifts(t):
    return density.density_2d(results(t), ["Sex"], "Best3BenchKg", "Best3DeadliftKg", 5, 5_000)


#: The point clouds of the exploration: two measures and their cell widths.
PANELS = {
    "weight and squat": ("BodyweightKg", 500, "Best3SquatKg", 500),
    "weight and bench": ("BodyweightKg", 500, "Best3BenchKg", 5),
    "weight and deadlift": ("BodyweightKg", 500, "Best3DeadliftKg", 5_000),
    "squat and bench": ("Best3SquatKg", 500, "Best3BenchKg", 5),
    "squat and deadlift": ("Best3SquatKg", 500, "Best3DeadliftKg", 5_000),
    "bench and deadlift": ("Best3BenchKg", 5, "Best3DeadliftKg", 5_000),
}


@query("density_panels")
def density_panels(t):
    return density.density_panels(results(t), ["Sex"], PANELS)


@query("scatter_sample")
def scatter_sample(t):
    """A twentieth of the points, chosen by a hash of their id."""
    place = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    points = t.lineitem.select(place.alias("id"), "l_quantity", "l_extendedprice")
    return ranking.split_by_threshold(points, "id", 0.05).filter("part = 'test'").drop("part")


@query("describe_bracketed")
def describe_bracketed(t):
    """As ``describe``, every column taken through its brackets."""
    columns = [c for c in RESULT_NUMBERS if c != "Tested"]
    stats = quantiles.describe(results(t), columns, accuracy=500, brackets=True)
    return rounded(stats, 4, "mean", "std", "min", "25%", "50%", "75%", "max")


@query("quartiles_bracketed")
def quartiles_bracketed(t):
    return rounded(quantiles.quartiles_by(results(t), ["Equipment", "Tested"], "TotalKg", 500), 4, "q1", "median", "q3")


@query("null_profile_all")
def null_profile_all(t):
    return aggregates.null_profile(results(t))


@query("quartiles_by_group")
def quartiles_by_group(t):
    return rounded(quantiles.quartiles_by(results(t), ["Equipment", "Tested"], "TotalKg"), 4, "q1", "median", "q3")


@query("violin_density")
def violin_density(t):
    shape = density.kernel_density(results(t), ["Equipment", "Tested"], "TotalKg", points=100, extend=2.0, continuous=True)
    # densities of large numbers are small: scale before rounding
    return rounded(shape.withColumn("density", F.col("density") * 1e6), 6, "x", "density")


# --- release decisions -----------------------------------------------------------


@query("normalise_category")
def normalise_category(t):
    raw = t.raw_decisions().select(recode.normalise("Gender").alias("gender"), recode.normalise("Race").alias("race"))
    return raw.groupBy("gender", "race").agg(F.count(F.lit(1)).alias("n"))


@query("recode_map")
def recode_map(t):
    return study.clean(t.raw_decisions()).groupBy("Gender", "Race").agg(F.count(F.lit(1)).alias("n"))


@query("assign_groups")
def assign_groups(t):
    grouped = study.clean(t.raw_decisions()).withColumn("Group", study.decision_group())
    return grouped.groupBy("Pretrial_Recommendation", "Judge_Followed_Recommendation", "Group").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("score_label")
def score_label(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        recode.score_label(F.when(F.col("l_quantity") != 1, F.col("l_linenumber") - 1)).alias("score"),
    )


@query("rate_by_group")
def rate_by_group(t):
    return rounded(study.rates(cases(t)), 6, "FTA_Rate")


@query("rate_label")
def rate_label(t):
    return study.rate_labels(cases(t))


@query("rate_by_group_release")
def rate_by_group_release(t):
    return rounded(study.rates_by_release(cases(t)), 6, "FTA_Rate")


@query("rate_by_group_score")
def rate_by_group_score(t):
    return rounded(study.rates_by_score(cases(t)), 6, "FTA_Rate")


@query("contingency")
def contingency(t):
    return study.outcome_table(cases(t))


@query("group_sizes")
def group_sizes(t):
    return study.group_sizes(cases(t))


@query("counts_by_score")
def counts_by_score(t):
    return study.counts_by(cases(t), "VPRAI_Score_Grouped")


@query("counts_by_attr")
def counts_by_attr(t):
    return study.counts_by(cases(t), "Gender")


@query("counts_by_race")
def counts_by_race(t):
    return study.counts_by(cases(t), "Race")


@query("outcome_by_gender")
def outcome_by_gender(t):
    return study.outcomes_by(cases(t), "Gender")


@query("outcome_by_race")
def outcome_by_race(t):
    return study.outcomes_by(cases(t), "Race")


@query("missed_by_score")
def missed_by_score(t):
    return study.missed_by_score(cases(t))


@query("monthly_trend")
def monthly_trend(t):
    return study.monthly_trend(cases(t))


@query("chi2_test")
def chi2_test(t):
    return rounded(chi_square.chi_square(cases(t), "Group", "FTA"), 6, "statistic")


@query("chi2_wide")
def chi2_wide(t):
    """Score levels against the outcome: six rows, no correction."""
    test = chi_square.chi_square(cases(t), "VPRAI_Score_Grouped", "FTA")
    return rounded(test, 6, "statistic")


@query("chi2_nullable")
def chi2_nullable(t):
    """A column with missing values and four levels."""
    races = cases(t).withColumn("Race", F.nullif("Race", F.lit("Other")))
    return rounded(chi_square.chi_square(races, "Gender", "Race"), 6, "statistic")


@query("chi2_expected")
def chi2_expected(t):
    return rounded(chi_square.expected_counts(cases(t), "Group", "FTA"), 4, "expected")


@query("chi2_pvalue")
def chi2_pvalue(t):
    test = chi_square.chi_square(cases(t), "Group", "FTA")
    return rounded(chi_square.with_p_value(test), 6, "statistic", "p_value")


@query("kde_by_group")
def kde_by_group(t):
    return rounded(study.age_density(cases(t)), 6, "x", "density")


@query("kde_all_vs_missed")
def kde_all_vs_missed(t):
    return rounded(study.age_density_of_missed(cases(t)), 6, "x", "density")


# --- quotes --------------------------------------------------------------------


@query("json_flatten")
def json_flatten(t):
    return nested.flatten(t.coins()).select(
        "event_id", "id", "name", "platform_name", "quote_USD_price", "quote_USD_volume_24h"
    )


@query("ingest_snapshots")
def ingest_snapshots(t):
    flat = nested.flatten(t.coins())
    rows = quotes.table_rows(quotes.transform(flat))
    return rounded(
        rows.select(
            "CoinID", "Name", "Symbol", F.col("CMC_Rank").cast("int").alias("CMC_Rank"),
            F.col("Circulating_Supply").cast("double").alias("Circulating_Supply"),
            F.col("Quote_USD_Price").cast("double").alias("Quote_USD_Price"),
            F.date_format("API_TimeStamp", "yyyy-MM-dd HH:mm:ss").alias("API_TimeStamp"),
        ),
        4, "Circulating_Supply", "Quote_USD_Price",
    )


@query("latest_snapshot")
def latest_snapshot(t):
    flat = nested.flatten(t.coins()).select("event_id", "id", "name", "quote_USD_price", "timestamp")
    newest = ranking.latest_per_key(flat, ["id"], ["timestamp", "event_id"])
    return newest.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


# --- shop orders -----------------------------------------------------------------


@query("receipt_rows")
def receipt_rows(t):
    return rounded(shop.receipt_rows(t.receipts()), 4, "total_price", "shipping_cost")


@query("receipt_times")
def receipt_times(t):
    times = shop.with_times(shop.receipt_rows(t.receipts()))
    return times.select(
        "receipt_id", "created_at", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("created_at_time", "updated_at_time")]
    )


@query("sale_line_rows")
def sale_line_rows(t):
    return rounded(shop.sale_line_rows(t.sale_lines()), 2, "price")


@query("json_page_explode")
def json_page_explode(t):
    """Fulfilment pages as JSON text, read with their schema, one row per item."""
    page = F.to_json(F.struct("id", "status", "shipped_at", "items"))
    orders = t.fulfilments().select(F.from_json(page, schemas.FULFILMENT).alias("o")).select("o.*")
    return rounded(shop.fulfilment_rows(orders), 4, "cost")


@query("receipt_lines")
def receipt_lines(t):
    lines = shop.receipt_lines(shop.receipt_rows(t.receipts()), shop.sale_line_rows(t.sale_lines()))
    return rounded(
        lines.select("transaction_id", "receipt_id", "buyer_user_id", "quantity", "price", "total_price"),
        2, "price", "total_price",
    )


@query("order_enrich")
def order_enrich(t):
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return rounded(shop.enrich_orders(orders, t.order_details()), 4, "subtotal", "shipping", "tax")


@query("fulfilment_match")
def fulfilment_match(t):
    items = shop.fulfilment_rows(t.fulfilments()).select("id", "transaction_id", "status", "cost")
    lines = shop.sale_line_rows(t.sale_lines()).select("transaction_id", "receipt_id", "quantity")
    return rounded(shop.match_fulfilments(items, lines), 4, "cost")


@query("fulfilment_unmatched")
def fulfilment_unmatched(t):
    items = shop.fulfilment_rows(t.fulfilments()).select("id", "transaction_id", "status")
    return shop.unmatched_fulfilments(items, t.sale_lines().select("transaction_id"))


# --- case notes ------------------------------------------------------------------


@query("parse_ts")
def parse_ts(t):
    text_date = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = recode.parse_timestamp(text_date, "yyyy-MM-dd", strict=False)
    return t.orders.select("o_orderkey", parsed.cast("date").alias("day"))


@query("try_numeric")
def try_numeric(t):
    return notes.select_closed(t.raw_notes()).select("doc_id", recode.number_or_null("Age").alias("age"))


@query("impute_mean")
def impute_mean(t):
    ages = notes.select_closed(t.raw_notes()).select("doc_id", recode.number_or_null("Age").alias("age"))
    return rounded(aggregates.fill_with_mean(ages, "age"), 4, "age")


@query("fill_missing")
def fill_missing(t):
    return notes.fill_defaults(notes.select_closed(t.raw_notes())).select(
        "doc_id", "Gender", "Race", "Risk", "arrests_past_year", "ProbationType", "DaysOnProbation", "EpicsDosagePastYear"
    )


@query("decade_bucket")
def decade_bucket(t):
    return notes.age_groups(notes.select_closed(t.raw_notes())).groupBy("AgeGroup").agg(F.count(F.lit(1)).alias("n"))


@query("clean_text")
def clean_text(t):
    return tfidf.by_document(t.documents, "doc_id", "text").select("doc_id", text.clean_note("text").alias("text"))


@query("remove_stopwords")
def remove_stopwords(t):
    texts = tfidf.by_document(t.documents, "doc_id", "text")
    return texts.select("doc_id", text.remove_stop_words(F.lower("text"), SHORT_STOP_LIST).alias("text"))


@query("remove_stopwords_default")
def remove_stopwords_default(t):
    """With the list that the classifier uses."""
    texts = tfidf.by_document(t.documents, "doc_id", "text")
    return texts.select("doc_id", text.remove_stop_words(F.lower("text")).alias("text"))


@query("ngrams")
def ngrams(t):
    """N-grams of every document by length: all, distinct, first and last in order."""
    texts = tfidf.by_document(t.documents, "doc_id", "text")
    return tfidf.term_lists(texts, "doc_id", "text", 4).select(
        "doc_id", "words",
        F.size("terms").cast("long").alias("n"),
        F.size(F.array_distinct("terms")).cast("long").alias("distinct_terms"),
        F.array_min("terms").alias("first_term"),
        F.array_max("terms").alias("last_term"),
    )


@query("tfidf_vocab")
def tfidf_vocab(t):
    return rounded(tfidf.vocabulary(t.documents, "doc_id", "text"), 6, "idf")


@query("tfidf")
def tfidf_weights(t):
    return rounded(tfidf.tfidf(t.documents, "doc_id", "text"), 6, "weight")


@query("one_hot")
def one_hot(t):
    filled = notes.fill_defaults(notes.select_closed(t.raw_notes())).select("doc_id", "Gender", "Risk", "ProbationType")
    levels = {
        "Gender": ["Other/Unknown", "de", "en", "es"],
        "Risk": ["High", "Not Assessed"],
        "ProbationType": ["Felony", "Misdemeanor Probation"],
    }
    return encode.one_hot(filled, levels)


@query("one_hot_all")
def one_hot_all(t):
    """All four text columns, levels from the data."""
    filled = notes.fill_defaults(notes.select_closed(t.raw_notes()))
    return encode.flags(filled, "doc_id", notes.CATEGORIES)


@query("encoded_categories")
def encoded_categories(t):
    """The classifier's fitted one-hot stages: fitted on the training part, applied to every row."""
    filled = notes.fill_defaults(notes.select_closed(t.raw_notes()))
    train = ranking.split(filled, "doc_id").filter("part = 'train'")
    return models.encoded(filled, "doc_id", notes.CATEGORIES, train)


@query("ridge_two_features")
def ridge_two_features(t):
    """The classifier's ridge on two numbers, every score."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", (F.col("n_chars") / 1000).alias("length"), F.col("toxic").cast("double").alias("toxic"),
        F.when(F.col("quality") == 1, 1.0).otherwise(-1.0).alias("_side"),
    )
    features = VectorAssembler(inputCols=["length", "toxic"], outputCol="features").transform(rows)
    size = rows.agg(F.count("_side").alias("rows"), F.stddev_samp("_side").alias("deviation")).first()
    model = models.drop_summary(models.ridge(size.rows, size.deviation).fit(features))
    return rounded(model.transform(features).select("doc_id", F.col("_score").alias("score")), 3, "score")


@query("ridge_held_out")
def ridge_held_out(t):
    """The classifier's ridge fitted on the training part: score and side of every held-out row."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", (F.col("n_chars") / 1000).alias("length"), F.col("toxic").cast("double").alias("toxic"),
        F.when(F.col("quality") == 1, 1.0).otherwise(-1.0).alias("_side"),
    )
    assembled = VectorAssembler(inputCols=["length", "toxic"], outputCol="features")
    parted = assembled.transform(cut_lineage(ranking.split(rows, "doc_id")))
    training = parted.filter("part = 'train'")
    size = training.agg(F.count("_side").alias("rows"), F.stddev_samp("_side").alias("deviation")).first()
    model = models.drop_summary(models.ridge(size.rows, size.deviation).fit(training))
    scored = model.transform(parted.filter("part = 'test'"))
    side = F.when(F.col("_score") > 0, 1).otherwise(0).alias("prediction")
    return rounded(scored.select("doc_id", F.col("_score").alias("score"), side), 3, "score")


@query("score_ridge_counts")
def score_ridge_counts(t):
    """Held-out rows per outcome, and how many of them got one of the two labels."""
    return _scored(t, "ridge").groupBy("Outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("Predictions").isin("Successful", "Unsuccessful")).alias("labelled"),
    )


@query("corr_with_outcome")
def corr_with_outcome(t):
    prepared = notes.age_groups(notes.fill_defaults(notes.select_closed(t.raw_notes())))
    return rounded(notes.feature_correlations(prepared), 6, "r")


@query("split_train_test")
def split_train_test(t):
    return ranking.split(t.documents.select("doc_id"), "doc_id")


@query("balance_classes")
def balance_classes(t):
    return ranking.balance(t.labels.select("doc_id", "quality"), "quality", "doc_id")


@query("union_all")
def union_all(t):
    line = t.lineitem.select("l_orderkey", "l_linestatus")
    return (
        line.filter("l_linestatus = 'F'")
        .unionByName(line.filter("l_linestatus = 'O'"))
        .groupBy("l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"))
    )


@query("accuracy")
def accuracy(t):
    """A rule guessing the line status from the return flag."""
    guess = F.when(F.col("l_returnflag") == "N", "O").otherwise("F")
    return rounded(
        aggregates.accuracy(t.lineitem.select("l_linestatus", guess.alias("guess")), "l_linestatus", "guess"), 6, "accuracy"
    )


@query("knn_votes")
def knn_votes(t):
    """The label that most of the five nearest training texts have, for every held-out text."""
    return notes.neighbour_votes(t.documents.join(t.labels, "doc_id"), "doc_id", "text", "quality")


def _scored(t, kind, **options):
    prepared = notes.prepare(t.raw_notes())
    scored = notes.hold_out(prepared, "doc_id", kind, **options)
    return scored.select("doc_id", "Outcome", "Predictions")


@query("score_ridge")
def score_ridge(t):
    return _scored(t, "ridge")


@query("score_forest")
def score_forest(t):
    return _scored(t, "forest")
