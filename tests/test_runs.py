import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.plans import quotes
from tallyworks.sources import ledger as ledgers
from tallyworks.sources import writers
from tallyworks.streaming import ingest
from tests.test_sources import NOW, Store, coin, land


class Killed(Exception):
    pass


class FragileLedger(ledgers.Ledger):
    """Ends the run before or after its n-th note."""

    left = None

    def note(self, *args):
        if FragileLedger.left == 0:
            raise Killed
        super().note(*args)
        if FragileLedger.left is not None:
            FragileLedger.left -= 0.5
            if FragileLedger.left == 0:
                raise Killed
            FragileLedger.left -= 0.5


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    made = Store(spark, tmp_path / "store")
    monkeypatch.setattr(writers, "jdbc_append", made.append)
    monkeypatch.setattr(quotes, "read_table", lambda s, url, name: made.table(name) if os.path.exists(f"{made.folder}/{name}")
                        else s.createDataFrame([], "CoinID int, API_TimeStamp timestamp"))
    return made


@pytest.mark.parametrize("left", [0, 0.5, 1, 1.5, 2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5])
def test_a_run_killed_between_any_two_steps_is_finished_by_the_next(spark, tmp_path, store, monkeypatch, left):
    monkeypatch.setattr(quotes, "Ledger", FragileLedger)
    monkeypatch.setattr(FragileLedger, "left", left)
    landing = tmp_path / "landing"
    land(landing, "1.json", [coin(1, 1.5), coin(2, 2.5), coin(3, 3.5)])
    paths = [str(tmp_path / p) for p in ("raw", "clean")]
    with pytest.raises(Killed):
        quotes.run(spark, str(landing), *paths, store.url, NOW)
    FragileLedger.left = None
    assert [quotes.run(spark, str(landing), *paths, store.url, NOW) for _ in range(2)] == [3, 3]
    assert [spark.read.parquet(p).count() for p in paths] == [3, 3]
    assert sorted(r.CoinID for r in store.table("quotes").collect()) == [1, 2, 3]


def test_a_table_that_got_some_rows_gets_the_others(spark, tmp_path, store, monkeypatch):
    landing = tmp_path / "landing"
    land(landing, "1.json", [coin(i, 1.5) for i in range(1, 6)])
    paths = [str(tmp_path / p) for p in ("raw", "clean")]

    def half(rows, settings):
        store.append(rows.filter("CoinID <= 2"), settings)
        raise Killed

    with monkeypatch.context() as broken:
        broken.setattr(writers, "jdbc_append", half)
        with pytest.raises(Killed):
            quotes.run(spark, str(landing), *paths, store.url, NOW)
    later = NOW + dt.timedelta(hours=1)
    assert quotes.run(spark, str(landing), *paths, store.url, NOW) == 5
    assert quotes.run(spark, str(landing), *paths, store.url, later) == 5
    assert store.table("quotes").groupBy("API_TimeStamp", "CoinID").count().filter("count = 1").count() == 10


def test_missing_rows_and_null_keys(frame):
    rows = frame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    there = frame([(None, "x"), (2, "y"), (2, "y")], "k int, v string")
    assert [tuple(r) for r in ledgers.missing_rows(rows, there, ["k"]).collect()] == [(1, "a")]


ORDERS = "id long, status string, price double, ts timestamp"


def test_only_changed_orders_go_on(spark, tmp_path):
    """A pull that is repeated with one changed status adds one row; every tick starts anew from the checkpoint."""
    source, out, state = (str(tmp_path / p) for p in ("orders", "out", "state"))

    def at(hours):
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)

    def pull(rows):
        spark.createDataFrame(rows, ORDERS).coalesce(1).write.mode("append").parquet(source)

    def tick():
        stream = spark.readStream.schema(ORDERS).parquet(source)
        changed = ingest.changed_only(stream, ["id"], "ts", "2 days")
        query = changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.id, r.status, r.ts) for r in spark.read.parquet(out).collect())

    pull([(1, "open", 5.0, at(0)), (2, "open", None, at(0)), (3, "paid", 7.0, at(0)), (3, "paid", 7.0, at(1))])
    first = [(1, "open", at(0)), (2, "open", at(0)), (3, "paid", at(0))]
    assert tick() == first
    assert tick() == first  # nothing landed
    pull([(1, "open", 5.0, at(2)), (2, "sent", None, at(2)), (3, "paid", 7.0, at(2))])
    assert tick() == sorted([*first, (2, "sent", at(2))])
    # older than the last of its key: nothing changes; back to an earlier state: a change
    pull([(2, "open", None, at(1)), (2, "open", None, at(3))])
    assert tick() == sorted([*first, (2, "sent", at(2)), (2, "open", at(3))])


def test_broken_pages_go_to_quarantine(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", [coin(1, 1.5), coin(2, 2.5)])
    (landing / "2.json").write_text('{"status": {"ok": 1}, "data": [{"id": 7')
    land(landing, "3.json", [coin(3, 3.5)])
    (landing / "4.json").write_text(json.dumps({"status": {"ok": 0}}))
    paths = [str(tmp_path / p) for p in ("records", "quarantine", "state")]

    def tick():
        ingest.load_with_quarantine(spark, str(landing), schemas.COIN_PAGE, "data", *paths).awaitTermination()
        good, bad = (spark.read.parquet(p) for p in paths[:2])
        return sorted(r.id for r in good.collect()), sorted((r.file.rsplit("/", 1)[1], r.error) for r in bad.collect())

    kept = [("2.json", "does not parse"), ("4.json", "has no data")]
    assert tick() == ([1, 2, 3], kept)
    assert tick() == ([1, 2, 3], kept)
    land(landing, "5.json", [coin(9, 1.0)])
    (landing / "6.json").write_text("not a page")
    assert tick() == ([1, 2, 3, 9], [*kept, ("6.json", "does not parse")])
    assert spark.read.parquet(paths[1]).filter(F.col("text") == "not a page").count() == 1
