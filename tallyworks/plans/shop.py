"""Shop orders: receipts, sale lines and fulfilments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks import schemas
from tallyworks.functions.nested import first_item
from tallyworks.sources.readers import read_json_pages
from tallyworks.sources.writers import append_table, stamp


def receipt_rows(receipts: DataFrame) -> DataFrame:
    """Receipt records as table rows; raw amounts and raw epoch seconds."""
    return receipts.select(
        "receipt_id",
        "buyer_user_id",
        F.col("name").alias("buyer_name"),
        F.col("email").alias("buyer_email"),
        "payment_status",
        F.col("grandtotal.amount").alias("total_price"),
        F.col("grandtotal.currency_code").alias("currency_code"),
        F.col("shipping_cost.amount").alias("shipping_cost"),
        F.col("creation_tsz").alias("created_at"),
        F.col("last_modified_tsz").alias("updated_at"),
    )


def sale_line_rows(lines: DataFrame) -> DataFrame:
    """Sale lines as table rows; a price is a number or an object with an amount."""
    amount = F.coalesce(F.get_json_object("price", "$.amount"), F.col("price")).try_cast("double")
    return lines.select(
        "transaction_id",
        "receipt_id",
        F.col("listing_id").alias("item_id"),
        "title",
        "quantity",
        amount.alias("price"),
        "sku",
        F.to_json("variations").alias("variation_details"),
    )


def fulfilment_rows(orders: DataFrame) -> DataFrame:
    """One row per fulfilled item, its order repeated; no row for an order without items."""
    return orders.select("id", "status", "shipped_at", F.explode("items").alias("item")).select(
        "id",
        F.col("item.referenceId").alias("transaction_id"),
        "status",
        F.col("item.cost").alias("cost"),
        F.col("item.shipping_method").alias("shipping_method"),
        F.col("item.tracking_number").alias("tracking_number"),
        "shipped_at",
    )


def enrich_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Every order with subtotal, shipping and tax of its first receipt, 0 if it has none."""
    return orders.join(details.select("id", "receipts"), "id", "left").select(
        *[F.col(c) for c in orders.columns],
        first_item("receipts", "productsPriceInitial").alias("subtotal"),
        first_item("receipts", "shippingPrice").alias("shipping"),
        first_item("receipts", "totalVat").alias("tax"),
    )


def receipt_lines(receipts: DataFrame, lines: DataFrame) -> DataFrame:
    return lines.join(receipts, "receipt_id")


def _by_reference(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with a reference, and those without: they find no partner, and stay where they are."""
    missing = F.col("transaction_id").isNull()
    return items.filter(~missing), items.filter(missing)


def with_times(receipts: DataFrame) -> DataFrame:
    """Receipt rows with timestamps next to the raw epoch seconds."""
    return receipts.withColumns({f"{c}_time": F.timestamp_seconds(c) for c in ("created_at", "updated_at")})


def match_fulfilments(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Fulfilled items with their sale line, where there is one."""
    known, unknown = _by_reference(items)
    matched = known.join(lines, "transaction_id", "left")
    return matched.unionByName(unknown, allowMissingColumns=True)


def unmatched_fulfilments(items: DataFrame, lines: DataFrame) -> DataFrame:
    known, unknown = _by_reference(items)
    return known.join(lines, "transaction_id", "left_anti").unionByName(unknown)


def save(
    receipts: DataFrame, lines: DataFrame, fulfilments: DataFrame, url: str, pulled_at: datetime
) -> dict[str, int]:
    """Append the three tables and return the rows written to each."""
    return {
        "receipts": append_table(stamp(receipt_rows(receipts), pulled_at), url, "receipts"),
        "transactions": append_table(stamp(sale_line_rows(lines), pulled_at), url, "transactions"),
        "fulfilments": append_table(stamp(fulfilment_rows(fulfilments), pulled_at), url, "fulfilments"),
    }


def run(spark: SparkSession, receipts: str, lines: str, fulfilments: str, url: str, pulled_at: datetime) -> dict[str, int]:
    """Landed pages of the three kinds to their tables; returns the rows written to each."""
    pages = (
        read_json_pages(spark, receipts, schemas.RECEIPT_PAGE, "results"),
        read_json_pages(spark, lines, schemas.SALE_LINE_PAGE, "results"),
        read_json_pages(spark, fulfilments, schemas.FULFILMENT_PAGE, "orders"),
    )
    return save(*pages, url, pulled_at)
