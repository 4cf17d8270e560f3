"""Logical tables on top of the star schema, the event log and the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyworks import schemas
from tallyworks.sources.readers import read_parquet

#: Rows of a join's larger side for each task, which sorts them.
TASK_ROWS = 500_000


class Tables:
    """Lazily read tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", nan_as_null=False)

    # --- video watching -------------------------------------------------------

    def plays(self) -> DataFrame:
        """Views without their viewer: no join is needed for them."""
        return self.lineitem.select(
            F.col("l_partkey").alias("video_id"), F.col("l_quantity").alias("watch_time_minutes")
        )

    def views(self) -> DataFrame:
        lines = self.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.orders.select("o_orderkey", "o_custkey")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").alias("viewer_id"),
            F.col("l_partkey").alias("video_id"),
            F.col("l_quantity").alias("watch_time_minutes"),
        )

    def videos(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("video_id"),
            F.col("p_type").alias("type"),
            F.col("p_name").alias("title"),
            F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genre"),
        )

    def viewers(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("viewer_id"), F.col("c_nationkey").alias("country_id")
        )

    def countries(self) -> DataFrame:
        return self.nation.select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country"))

    def lines_with_customers(self) -> DataFrame:
        """Order lines with their order, customer and nation.

        Orders find their customer first: they are fewer than lines. Large tables are cut into as many parts as
        their rows need, whatever the session's number is, so that no task has to sort more as they grow.
        """
        parts = -(-self.lineitem.count() // TASK_ROWS)
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

        def cut(table: DataFrame, key: str) -> DataFrame:
            return table.repartition(parts, key) if parts > least else table

        orders = (
            cut(self.orders, "o_custkey")
            .join(cut(self.customer, "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        )
        return cut(self.lineitem, "l_orderkey").join(cut(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))

    # --- meet results ---------------------------------------------------------

    def raw_results(self) -> DataFrame:
        """Untreated meet results, one per order line."""
        joined = self.lines_with_customers()
        quantity = F.when(F.col("l_quantity") != 1, F.col("l_quantity"))
        return joined.select(
            F.col("c_name").alias("Name"),
            F.col("c_mktsegment").alias("Sex"),
            F.col("o_orderstatus").alias("Equipment"),
            F.col("o_orderpriority").alias("AgeClass"),
            F.when(F.col("l_linestatus") == "F", "Yes").otherwise("No").alias("Tested"),
            F.col("o_orderdate").alias("Date"),
            F.col("n_name").alias("MeetName"),
            F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("MeetCountry"),
            F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Federation"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("ParentFederation"),
            F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("BodyweightKg"),
            F.col("c_acctbal").alias("Best3SquatKg"),
            quantity.alias("Best3BenchKg"),
            F.col("l_extendedprice").alias("Best3DeadliftKg"),
            F.col("o_totalprice").alias("TotalKg"),
            F.col("c_acctbal").alias("Squat1Kg"),
            (F.col("l_discount") - 0.05).alias("Squat2Kg"),
            (F.col("l_tax") - 0.04).alias("Squat3Kg"),
            (-F.col("c_acctbal")).alias("Bench1Kg"),
            (0.05 - F.col("l_discount")).alias("Bench2Kg"),
            (0.04 - F.col("l_tax")).alias("Bench3Kg"),
            (F.col("l_quantity") - 25).alias("Deadlift1Kg"),
            (quantity - 10).alias("Deadlift2Kg"),
            (F.col("l_linenumber") - 2).alias("Deadlift3Kg"),
        )

    # --- release decisions ----------------------------------------------------

    def raw_decisions(self) -> DataFrame:
        joined = (
            self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        )
        return joined.select(
            F.when(F.col("o_orderpriority") == "1-URGENT", "Detain")
            .when(F.col("o_orderpriority") != "2-HIGH", "Release on own recognizance")
            .alias("Pretrial_Recommendation"),
            F.when(F.col("l_linestatus") == "F", "Yes").otherwise("No").alias("Judge_Followed_Recommendation"),
            choose(
                "c_mktsegment", MACHINERY=" Male ", BUILDING="FEMALE", FURNITURE="\tmale\n", HOUSEHOLD="unknown"
            ).alias("Gender"),
            choose(
                "p_type", STANDARD=" Black", ECONOMY="white ", MEDIUM="Hispanic/Latin/Mexican",
                PROMO="FILIPINO", LARGE="martian",
            ).alias("Race"),
            F.when(F.col("l_quantity") != 1, F.col("l_linenumber") - 1).alias("VPRAI_Score"),
            F.when(F.col("l_returnflag") == "R", "Yes").when(F.col("l_returnflag") == "A", "No").alias("FTA"),
            F.col("l_quantity").alias("AgeAtBooking"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("Booking_Date"),
            F.col("o_orderstatus").alias("Release_Type"),
        )

    # --- quotes -----------------------------------------------------------------

    def coin_texts(self) -> DataFrame:
        """One landed page of JSON text per event, holding a single coin."""
        coin = F.struct(
            F.col("user_id").alias("id"),
            F.col("event_type").alias("name"),
            F.upper("event_type").alias("symbol"),
            F.get_json_object("props", "$.k").cast("long").alias("cmc_rank"),
            (F.col("value") * 10).alias("circulating_supply"),
            F.when(F.col("event_type") == "view", F.struct(F.lit("chain").alias("name"))).alias("platform"),
            F.struct(
                F.struct(F.col("value").alias("price"), (F.col("value") * 100).alias("volume_24h")).alias("USD")
            ).alias("quote"),
        )
        page = F.to_json(F.struct(F.array(coin).alias("data")))
        return self.events.select("event_id", F.col("ts").cast("timestamp").alias("timestamp"), page.alias("page"))

    def coins(self) -> DataFrame:
        parsed = self.coin_texts().select("event_id", "timestamp", F.from_json("page", schemas.COIN_PAGE).alias("p"))
        return parsed.select("event_id", "timestamp", F.explode("p.data").alias("c")).select(
            "event_id", "timestamp", "c.*"
        )

    # --- shop orders ------------------------------------------------------------

    def receipts(self) -> DataFrame:
        placed = F.unix_date(F.to_date("o_orderdate")).cast("long") * 86_400
        return self.orders.select(
            F.col("o_orderkey").alias("receipt_id"),
            F.col("o_custkey").alias("buyer_user_id"),
            F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
            F.lit(None).cast("string").alias("email"),
            F.col("o_orderstatus").alias("payment_status"),
            F.when(
                F.col("o_orderstatus") != "P",
                F.struct(F.col("o_totalprice").alias("amount"), F.lit("USD").alias("currency_code")),
            ).alias("grandtotal"),
            F.struct((F.col("o_totalprice") / 100).alias("amount")).alias("shipping_cost"),
            placed.alias("creation_tsz"),
            (placed + 3600).alias("last_modified_tsz"),
        )

    def sale_lines(self) -> DataFrame:
        """One line per order and line number, which the order lines repeat."""
        return (
            self.lineitem.groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.min("l_partkey").alias("listing_id"),
                F.sum("l_quantity").cast("long").alias("quantity"),
                F.max("l_extendedprice").alias("price"),
            )
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
                F.col("l_orderkey").alias("receipt_id"),
                "listing_id",
                F.concat(F.lit("Item "), F.col("listing_id").cast("string")).alias("title"),
                "quantity",
                F.col("price").cast("string").alias("price"),
                F.concat(F.lit("SKU-"), F.col("listing_id").cast("string")).alias("sku"),
                F.array(
                    F.struct(F.col("l_linenumber").cast("long").alias("property_id"), F.lit("size").alias("value"))
                ).alias("variations"),
            )
        )

    def fulfilments(self) -> DataFrame:
        """Orders of two items: the sale line itself, and the next line, which may not exist."""
        shipped = F.concat(F.lit("day "), (F.col("transaction_id") % 7).cast("string"))

        def item(reference: Column, cost: Column, method: str) -> Column:
            return F.struct(
                reference.alias("referenceId"),
                cost.alias("cost"),
                F.lit(method).alias("shipping_method"),
                F.concat(F.lit("T"), reference.cast("string")).alias("tracking_number"),
            )

        return self.sale_lines().select(
            F.concat(F.lit("G"), F.col("transaction_id").cast("string")).alias("id"),
            F.when(F.col("quantity") > 25, "shipped").otherwise("printed").alias("status"),
            shipped.alias("shipped_at"),
            F.array(
                item(F.col("transaction_id"), F.col("quantity") / 2, "normal"),
                item(F.col("transaction_id") + 1, F.col("quantity") / 4, "express"),
            ).alias("items"),
        )

    def order_details(self) -> DataFrame:
        """Per order a list with one receipt, or an empty list for small orders."""
        sums = self.lineitem.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("productsPriceInitial"),
            F.max("l_extendedprice").alias("shippingPrice"),
            F.min("l_tax").alias("totalVat"),
        )
        receipt = F.struct("productsPriceInitial", "shippingPrice", "totalVat")
        return sums.select(
            F.col("l_orderkey").alias("id"),
            F.when(F.col("n") > 2, F.array(receipt)).otherwise(F.filter(F.array(receipt), lambda _: F.lit(False))).alias("receipts"),
        )

    # --- case notes ---------------------------------------------------------------

    def raw_notes(self) -> DataFrame:
        return self.documents.join(self.labels, "doc_id").select(
            "doc_id",
            F.col("text").alias("Last10Chronos"),
            F.when(F.col("quality") == 1, "Successful").otherwise("Unsuccessful").alias("CloseType"),
            F.when(F.col("lang") != "fr", F.col("lang")).alias("Gender"),
            F.when(F.col("source") != "src3", F.col("source")).alias("Race"),
            F.when(F.col("toxic") == 1, "High").alias("Risk"),
            F.when(F.col("lang") == "es", "n/a").otherwise((F.col("n_chars") % 60 + 18).cast("string")).alias("Age"),
            F.col("toxic").cast("double").alias("arrests_past_year"),
            F.when(F.col("n_chars") > 1000, "Felony").alias("ProbationType"),
            F.when(F.col("n_chars") > 300, F.col("n_chars").cast("double")).alias("DaysOnProbation"),
            (F.col("n_chars") % 11).cast("double").alias("EpicsDosagePastYear"),
        )


def choose(column: str, **texts: str) -> Column:
    """The text given for the column's value, NULL for other values."""
    choice = None
    for value, text in texts.items():
        condition = F.col(column) == value
        choice = F.when(condition, text) if choice is None else choice.when(condition, text)
    return choice
