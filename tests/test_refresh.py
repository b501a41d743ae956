"""Adding days to a snapshot reads and writes the stretch that they change, and gives what a whole run gives."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewalk.config import GapPatch
from tidewalk.plans import refresh
from tidewalk.plans.daily_features import daily_features
from tidewalk.schemas import SNAPSHOT
from tidewalk.sources import tables
from tidewalk.sources.proxies import market_tables

COLUMNS = SNAPSHOT.fieldNames()


@pytest.fixture(scope="module")
def market(spark, sf_dir):
    return {name: tables.materialise(df, f"market-{name}") for name, df in market_tables(spark, sf_dir, 4).items()}


def upto(market, day, series=None):
    def cut(table):
        if "trade_date" not in table.columns:
            return table
        late = F.col("trade_date") <= day if series is None else (F.col("trade_date") <= day) | (F.col("series_id") != series)
        return table.where(late)

    return {name: cut(table) for name, table in market.items()}


def whole(market, patches=()):
    return rows(daily_features(market, patches=patches).select(COLUMNS), "series_id", "trade_date")


def written(spark, path):
    return rows(refresh.read_monthly(spark, path).select(COLUMNS), "series_id", "trade_date")


def test_steps_equal_one_run(spark, market, tmp_path):
    path = str(tmp_path / "s")
    refresh.write_monthly(daily_features(upto(market, "1996-03-10"), patches=()), path)
    for day in ("1996-03-11", "1996-03-12", "1997-01-31", "1999-12-31"):
        refresh.refresh(upto(market, day), path, patches=())
        assert written(spark, path) == whole(upto(market, day))
    assert refresh.refresh(upto(market, "1999-12-31"), path, patches=()) == 0


def test_one_series_grows_alone(spark, market, tmp_path):
    path, series = str(tmp_path / "s"), "S002"
    refresh.write_monthly(daily_features(upto(market, "1996-06-30", series), patches=()), path)
    before = {d: os.stat(tmp_path / "s" / d).st_mtime_ns for d in os.listdir(tmp_path / "s") if d.startswith("month")}
    changed = refresh.refresh(upto(market, "1996-07-10", series), path, patches=())
    assert written(spark, path) == whole(upto(market, "1996-07-10", series))
    assert 0 < changed
    untouched = [d for d, t in before.items() if os.stat(tmp_path / "s" / d).st_mtime_ns == t]
    assert len(untouched) > 40 // 12  # months before the stretch keep their files


def test_a_new_series_comes_with_its_history(spark, market, tmp_path):
    path = str(tmp_path / "s")
    without = {
        n: t.where("series_id <> 'S001'") if "trade_date" in t.columns else t for n, t in upto(market, "1996-09-30").items()
    }
    refresh.write_monthly(daily_features(without, patches=()), path)
    refresh.refresh(upto(market, "1996-09-30"), path, patches=())
    assert written(spark, path) == whole(upto(market, "1996-09-30"))


@pytest.mark.parametrize("first", ["1996-05-31", "1996-06-07", "1996-06-08", "1996-06-20", "1996-07-31"])
def test_patched_days_wait_for_their_neighbours(spark, market, tmp_path, first):
    """The day before, the patched day or its later neighbour may be the last one that a snapshot knew."""
    holes = {**market, "participant_activity": market["participant_activity"].where("trade_date <> '1996-06-08'")}
    patches = (GapPatch("1996-06-08", "fii_fut_net_pct", ("fii_fut_net_pct",), ("1996-06-05", "1996-07-15")),)
    path = str(tmp_path / "s")
    refresh.write_monthly(daily_features(upto(holes, first), patches=patches), path)
    refresh.refresh(upto(holes, "1996-09-30"), path, patches=patches)
    assert written(spark, path) == whole(upto(holes, "1996-09-30"), patches)


def test_stretch_is_a_few_rows(spark, market):
    days = daily_features(market, patches=()).select("series_id", "trade_date")
    known = days.where("trade_date <= '1997-06-30'")
    found = {r.series_id: r for r in refresh.stretches(known, days, ()).collect()}
    assert len(found) == 4
    for series, r in found.items():
        own = sorted(d[1] for d in known.where(F.col("series_id") == series).collect())
        assert (r.redo, r.since) == (own[-20], own[-25])
    assert refresh.stretches(days, days, ()).isEmpty()
    short = known.where("trade_date <= '1992-01-20'")
    assert all(r.redo >= dt.date(1992, 1, 1) and r.since <= r.redo for r in refresh.stretches(short, days, ()).collect())


def test_files_are_in_key_order(spark, tmp_path):
    data = [(f"S{i % 7}", dt.date(2000, 1, 1) + dt.timedelta(days=i * 37 % 900)) for i in range(3000)]
    frame = spark.createDataFrame(data, "series_id string, trade_date date").distinct()
    for parts in (1, 5):
        path = str(tmp_path / f"o{parts}")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts == 1)
        try:
            tables.write_ordered(frame, path)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
        placed = rows(tables.in_file_order(spark.read.parquet(path)), "place")
        assert [p[2] for p in placed] == list(range(1, len(placed) + 1))
        assert [(p[1], p[0]) for p in placed] == sorted((d, s) for s, d in {tuple(r) for r in data})
    assert len([n for n in os.listdir(path) if n.startswith("part-")]) > 1
