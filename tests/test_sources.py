"""Readers, writers and the incremental loads, on files the tests write."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from tallyworks import schemas
from tallyworks.operators.ranking import latest_per_key
from tallyworks.plans import quotes, shop
from tallyworks.sources import readers, writers
from tallyworks.streaming import ingest

NOW = dt.datetime(2024, 5, 1, 12, 0)


class Store:
    """Stands in for a database, which the tests must not start: tables are folders."""

    url = "jdbc:store"

    def __init__(self, spark, folder):
        self.spark, self.folder, self.settings = spark, folder, {}

    def append(self, rows, settings):
        self.settings = settings
        rows.write.mode("append").parquet(f"{self.folder}/{settings['dbtable']}")

    def table(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}")


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    store = Store(spark, tmp_path / "store")
    monkeypatch.setattr(writers, "jdbc_append", store.append)
    return store


def test_bom_crlf_and_blank_in_header(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_bytes("﻿country_id,Country,Country Code\r\n1,UNITED KINGDOM,GB\r\n2,KOREA,KR\r\n".encode())
    df = readers.read_csv(spark, str(path), schemas.COUNTRIES)
    assert [tuple(r) for r in df.collect()] == [(1, "UNITED KINGDOM", "GB"), (2, "KOREA", "KR")]
    inferred = readers.read_csv(spark, str(path), rename={"Country": "country", "Country Code": "country_code"})
    assert inferred.columns == ["country_id", "country", "country_code"]
    assert inferred.schema["country_id"].dataType == T.IntegerType()
    assert inferred.first().country_id == 1


def test_broken_numbers_stop_a_strict_read(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("viewer_id,country_id\n1,x\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, str(path), schemas.VIEWERS).collect()
    lenient = readers.read_csv(spark, str(path), schemas.VIEWERS, mode="PERMISSIVE")
    assert tuple(lenient.first()) == (1, None)


def test_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("Country ID,extra,viewer_id\n44,x,7\n")
    assert tuple(readers.read_csv(spark, str(path), schemas.VIEWERS).first()) == (7, 44)
    renamed = readers.read_csv(spark, str(path), schemas.VIEWERS, rename={"extra": "viewer_id", "viewer_id": "other"}, mode="PERMISSIVE")
    assert tuple(renamed.first()) == (None, 44)
    path.write_text("viewer_id,extra\n7,x\n")
    with pytest.raises(ValueError, match="no column country_id"):
        readers.read_csv(spark, str(path), schemas.VIEWERS)


def test_parquet_filters_reach_the_scan(spark, tables):
    from __spark_entry__ import queries
    from tests.conftest import SMALL

    plan = queries()["scan_parquet"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,25" in plan


def test_windows_1252(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_bytes(b"note\nna\xefve \x80\n")
    with readers.windows_charsets(spark):
        rows = readers.read_csv_cp1252(spark, str(path), T.StructType([T.StructField("note", T.StringType())])).collect()
    assert rows[0].note == "naïve €"
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_zip_takes_the_last_csv_member(spark, tmp_path):
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("TotalKg", T.DoubleType()), T.StructField("n", T.IntegerType())])
    for i in (1, 2):
        with zipfile.ZipFile(tmp_path / f"results{i}.zip", "w") as z:
            z.writestr("a.csv", "Name,TotalKg,n\nold,1,1\n")
            z.writestr("readme.txt", "text")
            z.writestr(f"day{i}.csv", f'﻿Name,n,TotalKg\n"A, B",{i},100.5\nC,,\n')
    df = readers.read_zipped_csv(spark, str(tmp_path), schema, rows_per_batch=1)
    assert sorted((tuple(r) for r in df.collect()), key=str) == [("A, B", 100.5, 1), ("A, B", 100.5, 2), ("C", None, None), ("C", None, None)]


def test_zip_members_stream_and_odd_archives(spark, tmp_path):
    import tracemalloc

    folder = tmp_path / "with blank, 100%"
    folder.mkdir()
    with zipfile.ZipFile(folder / "big one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("skipped.csv", "k,v\nno,no\n")
        with z.open("a.csv", "w") as member:
            member.write(b"k,v\n")
            for i in range(200):
                member.write(b"".join(b"%d,%s\n" % (i * 1000 + j, b"x" * 200) for j in range(1000)))
        z.writestr("z.txt", "k,v\n")
    with zipfile.ZipFile(folder / "none.zip", "w") as z:
        z.writestr("readme.txt", "text")
    with zipfile.ZipFile(folder / "empty.zip", "w") as z:
        z.writestr("e.csv", "k,v\n")
    # 40 MB of text pass through a few batches' room
    tracemalloc.start()
    sizes = [len(b) for b in readers.member_rows(readers.open_file, f"file:{folder}/big one.zip", ["k"], 1000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 200_000 and max(sizes) <= 1000 and peak < 12 << 20
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.StringType())])
    df = readers.read_zipped_csv(spark, str(folder), schema)
    total = df.agg(F.count("*"), F.sum("k"), F.min(F.length("v")), F.count("w")).first()
    assert tuple(total) == (200_000, 200_000 * 199_999 // 2, 200, 0)
    # the listing holds paths, not contents
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_zip_by_an_opener_of_ones_own(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("a.csv", "k\n1\n")
    schema = T.StructType([T.StructField("k", T.LongType())])

    def opened(path):
        return open(path.removeprefix("file:"), "rb")

    assert [r.k for r in readers.read_zipped_csv(spark, str(tmp_path), schema, opened=opened).collect()] == [1]


def test_parquet_nan(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (2.0,)], "x double").write.parquet(str(tmp_path / "p"))
    assert sorted(r.x or 0 for r in readers.read_parquet(spark, str(tmp_path / "p")).collect()) == [0, 2.0]


def test_writers_count_rows(spark, tmp_path):
    df = writers.stamp(spark.range(10), NOW, "timestamp")
    assert writers.overwrite_parquet(df, str(tmp_path / "p")) == 10
    assert writers.overwrite_parquet(df.filter("id < 3"), str(tmp_path / "p")) == 3
    assert spark.read.parquet(str(tmp_path / "p")).first().timestamp == NOW
    for _ in range(2):
        assert writers.append_snapshot(df, str(tmp_path / "s")) == 10
    snapshots = spark.read.parquet(str(tmp_path / "s"))
    assert snapshots.count() == 20 and snapshots.first().ingest_date == NOW.date()
    assert writers.overwrite_csv(df, str(tmp_path / "c")) == 10
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "timestamp"]


def test_append_to_a_table(spark, store):
    df = spark.range(25).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("other"))
    assert writers.append_table(df, store.url, "t", ["name", "id"], batch=10, numPartitions="2") == 25
    assert store.settings == {"url": store.url, "dbtable": "t", "batchsize": "10", "numPartitions": "2"}
    assert writers.append_table(df, store.url, "t", ["name", "id"]) == 25
    assert store.table("t").columns == ["name", "id"] and store.table("t").count() == 50


def coin(i, price, platform=True):
    parent = {"name": "chain", "symbol": "CH", "slug": "ch"} if platform else None
    return {
        "id": i, "name": f"coin{i}", "symbol": f"C{i}", "slug": "s", "num_market_pairs": 3, "cmc_rank": i,
        "circulating_supply": 10.0, "total_supply": 20.5, "date_added": "2020-01-01T00:00:00Z",
        "last_updated": "2024-01-01T00:00:00Z", "platform": parent,
        "quote": {"USD": {"price": price, "volume_24h": 5.0, "last_updated": "2024-01-01T00:00:00Z"}},
    }


def land(folder, name, records, key="data"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"status": {"ok": 1}, key: records}, indent=1))


def test_quote_snapshots_end_to_end(spark, tmp_path, store):
    landing = tmp_path / "landing"
    land(landing, "1.json", [coin(1, 1.5), coin(2, 2.5, platform=False)])
    flat = quotes.extract(spark, str(landing), NOW)
    assert {"platform_name", "quote_USD_price", "timestamp"} <= set(flat.columns)
    assert {r.id: r.platform_name for r in flat.collect()} == {1: "chain", 2: None}
    paths = [str(tmp_path / p) for p in ("raw", "clean")]
    for hours in (0, 1):
        assert quotes.run(spark, str(landing), *paths, store.url, NOW + dt.timedelta(hours=hours)) == 2
    clean = spark.read.parquet(paths[1]).drop("ingest_date")
    assert clean.schema["cmc_rank"].dataType == T.ShortType() and clean.count() == 4
    assert {r.timestamp for r in quotes.latest(clean).collect()} == {NOW + dt.timedelta(hours=1)}
    table = store.table("quotes")
    assert table.columns[:2] == ["CoinID", "Name"] and table.count() == 4


def test_incremental_load_equals_its_batch_twin(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, "1.json", [coin(1, 1.5), coin(2, 2.5)])

    def tick():
        records = ingest.landed_records(spark, str(landing), schemas.COIN_PAGE, "data")
        fresh = ingest.drop_repeats(records, ["id", "quote_USD_price"], "timestamp", "10 days")
        ingest.append_files(fresh, out, state).awaitTermination()
        return spark.read.parquet(out)

    assert tick().count() == 2
    assert tick().count() == 2  # nothing new landed
    land(landing, "2.json", [coin(2, 2.5), coin(3, 3.5, platform=False), coin(1, 9.0)])
    loaded = tick()
    assert sorted((r.id, r.quote_USD_price) for r in loaded.collect()) == [(1, 1.5), (1, 9.0), (2, 2.5), (3, 3.5)]
    batch = readers.read_json_pages(spark, str(landing), schemas.COIN_PAGE, "data").select("id", "quote.USD.price").distinct()
    assert loaded.select("id", F.col("quote_USD_price").alias("price")).exceptAll(batch).count() == 0
    assert latest_per_key(loaded.select("id", "timestamp"), ["id"], ["timestamp"]).count() == 3


def test_a_broken_page_stops_the_stream(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, "1.json", [coin(1, 1.5)])
    (landing / "2.json").write_text('{"data": [{"id": 2, "name"')
    records = ingest.landed_records(spark, str(landing), schemas.COIN_PAGE, "data")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|STREAM_FAILED"):
        ingest.append_files(records, out, state).awaitTermination()
    land(landing, "2.json", [coin(2, 2.5)])  # landed again in full: nothing was marked as done
    records = ingest.landed_records(spark, str(landing), schemas.COIN_PAGE, "data")
    ingest.append_files(records, out, state).awaitTermination()
    assert {r.id for r in spark.read.parquet(out).collect()} == {1, 2}


def test_a_repeated_pull_is_there_once(spark, tmp_path, store):
    landing = tmp_path / "landing"
    land(landing, "1.json", [coin(1, 1.5), coin(2, 2.5)])
    paths = [str(tmp_path / p) for p in ("raw", "clean")]
    assert [quotes.run(spark, str(landing), *paths, store.url, NOW) for _ in range(2)] == [2, 2]
    assert [spark.read.parquet(p).count() for p in paths] == [2, 2]
    assert store.table("quotes").count() == 2


def test_two_tables_of_meets_are_written(spark, tmp_path, tables):
    from tallyworks.plans import meets

    raw = tables.raw_results()
    paths = [str(tmp_path / p) for p in ("results", "meets")]
    written = meets.run(raw, *paths)
    prepared = meets.prepare_results(raw)
    assert written == {"results": prepared.count(), "meets": meets.meets(prepared).count()}
    assert spark.read.parquet(paths[1]).exceptAll(meets.meets(prepared)).count() == 0


def test_batches_reach_a_table_and_months_are_counted(spark, tmp_path, tables, store):
    source = str(tmp_path / "events")
    tables.events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def write(batch, number):
        writers.append_table(batch, store.url, "events", ["event_id", "event_type"])

    ingest.for_each_batch(stream, write, str(tmp_path / "state")).awaitTermination()
    assert store.table("events").count() == tables.events.count()

    months = ingest.monthly_counts(stream, "ts", ["event_type"])
    query = (
        months.writeStream.format("memory").queryName("months").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "months")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = ingest.monthly_counts(spark.read.parquet(source), "ts", ["event_type"])
    assert spark.table("months").exceptAll(batch).count() == 0 and batch.count() == 5


def test_shop_pages_end_to_end(spark, tmp_path, store):
    land(tmp_path / "r", "1.json", [
        {"receipt_id": 1, "buyer_user_id": 7, "name": "N", "email": "e", "payment_status": "paid",
         "grandtotal": {"amount": 12.5, "currency_code": "USD"}, "creation_tsz": 1700000000, "last_modified_tsz": 1},
        {"receipt_id": 2, "grandtotal": None, "shipping_cost": {"amount": 3}},
    ], "results")
    land(tmp_path / "l", "1.json", [
        {"transaction_id": 10, "receipt_id": 1, "listing_id": 5, "title": "T", "quantity": 2, "price": "4.5", "sku": "s",
         "variations": [{"property_id": 1, "value": "red"}]},
        {"transaction_id": 11, "receipt_id": 1, "price": {"amount": 6.25}, "variations": []},
    ], "results")
    land(tmp_path / "f", "1.json", [
        {"id": "g1", "status": "shipped", "shipped_at": "d", "items": [{"referenceId": 10, "cost": 1.0}, {"referenceId": 99}]},
        {"id": "g2", "status": "new", "items": []},
    ], "orders")
    receipts = readers.read_json_pages(spark, str(tmp_path / "r"), schemas.RECEIPT_PAGE, "results")
    lines = readers.read_json_pages(spark, str(tmp_path / "l"), schemas.SALE_LINE_PAGE, "results")
    orders = readers.read_json_pages(spark, str(tmp_path / "f"), schemas.FULFILMENT_PAGE, "orders")
    assert {r.receipt_id: (r.total_price, r.shipping_cost) for r in shop.receipt_rows(receipts).collect()} == {1: (12.5, None), 2: (None, 3.0)}
    sold = {r.transaction_id: (r.price, r.variation_details) for r in shop.sale_line_rows(lines).collect()}
    assert sold == {10: (4.5, '[{"property_id":1,"value":"red"}]'), 11: (6.25, "[]")}
    items = shop.fulfilment_rows(orders)
    assert items.count() == 2
    matched = {r.transaction_id: r.receipt_id for r in shop.match_fulfilments(items, lines.select("transaction_id", "receipt_id")).collect()}
    assert matched == {10: 1, 99: None}
    assert [r.transaction_id for r in shop.unmatched_fulfilments(items, lines).collect()] == [99]
    details = spark.createDataFrame([("g1", [(5.0, None, 2.0)])], schemas.ORDER_DETAIL)
    rich = {r.id: (r.subtotal, r.shipping, r.tax) for r in shop.enrich_orders(orders, details).collect()}
    assert rich == {"g1": (5.0, 0.0, 2.0), "g2": (0.0, 0.0, 0.0)}
    assert shop.save(receipts, lines, orders, store.url, NOW) == {"receipts": 2, "transactions": 2, "fulfilments": 2}
    again = shop.run(spark, *(str(tmp_path / p) for p in "rlf"), store.url, NOW)
    assert again == {"receipts": 2, "transactions": 2, "fulfilments": 2} and store.table("receipts").count() == 4
    unknown = items.unionByName(items.limit(1).withColumn("transaction_id", F.lit(None).cast("long")))
    assert sorted(str(r.transaction_id) for r in shop.unmatched_fulfilments(unknown, lines).collect()) == ["99", "None"]
    assert shop.match_fulfilments(unknown, lines.select("transaction_id", "receipt_id")).count() == 3
