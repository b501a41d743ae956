import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewalk.config import GapPatch
from tidewalk.operators import assembly
from tidewalk.plans.daily_features import daily_features
from tidewalk.schemas import SNAPSHOT
from tidewalk.sources.proxies import market_tables

D = [dt.date(2020, 1, d) for d in range(1, 6)]
PATCH = GapPatch("2020-01-02", "a", ("a", "b"), ("2020-01-01", "2020-01-03"))


def frame(spark, *values, series="S"):
    return spark.createDataFrame(
        [(series, d, a, b) for d, (a, b) in zip(D, values)], "series_id string, trade_date date, a double, b double"
    )


def test_guard_decides_for_all_columns(spark):
    got = rows(assembly.patch_gaps(frame(spark, (1.0, 10.0), (None, 99.0), (3.0, 30.0)), [PATCH]), "trade_date")
    assert got[1][2:] == (2.0, 20.0)
    kept = rows(assembly.patch_gaps(frame(spark, (1.0, 10.0), (7.0, None), (3.0, 30.0)), [PATCH]), "trade_date")
    assert kept[1][2:] == (7.0, None)


def test_neighbour_mean_skips_nulls_and_stays_in_its_series(spark):
    df = frame(spark, (1.0, None), (None, 5.0), (3.0, 30.0)).union(frame(spark, (9.0, 9.0), (None, 9.0), series="T"))
    got = {(r[0], r[1]): r[2:] for r in rows(assembly.patch_gaps(df, [PATCH]))}
    assert got[("S", D[1])] == (2.0, 30.0) and got[("T", D[1])] == (9.0, 9.0)


def test_patch_of_one_series_leaves_others(spark):
    only_t = GapPatch("2020-01-02", "a", ("a",), ("2020-01-01",), series_id="T")
    df = frame(spark, (1.0, 1.0), (None, 1.0)).union(frame(spark, (9.0, 9.0), (None, 9.0), series="T"))
    got = {(r[0], r[1]): r[2] for r in rows(assembly.patch_gaps(df, [only_t]))}
    assert got[("S", D[1])] is None and got[("T", D[1])] == 9.0


def test_fill_behaves_like_update_from(spark):
    source = frame(spark, (None, 5.0), (8.0, 6.0)).limit(2)
    got = rows(
        assembly.fill_columns(
            frame(spark, (1.0, 1.0), (2.0, 2.0), (3.0, 3.0)), source, {"a": F.col("a"), "new": F.col("b")}
        ),
        "trade_date",
    )
    assert [r[2] for r in got] == [None, 8.0, 3.0]
    assert [r[4] for r in got] == [5.0, 6.0, None]


def test_daily_features_have_the_declared_schema(spark, sf_dir):
    df = daily_features(market_tables(spark, sf_dir))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SNAPSHOT]


def test_a_side_with_two_rows_for_a_day_is_an_error(spark, sf_dir):
    tables = market_tables(spark, sf_dir)
    summary = tables["market_activity_summary"]
    with pytest.raises(Exception, match="more than one row"):
        daily_features({**tables, "market_activity_summary": summary.unionAll(summary)}).collect()


def test_row_order_logic_adds_one_exchange_and_one_sort(spark, sf_dir):
    """Returns, patches and deltas share the exchange by series: no exchange sits between the four windows."""
    plan = daily_features(market_tables(spark, sf_dir, 16))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line and "series_id" in line]
    between = lines[windows[0]: windows[3] + 1]
    assert not any("Exchange" in line or "Sort [" in line for line in between)


def test_repeated_keys_are_found_before_the_join(spark):
    df = frame(spark, (1.0, 10.0), (None, 2.0))
    assert rows(assembly.one_row_per_day(df), "trade_date") == rows(df, "trade_date")
    with pytest.raises(Exception, match="more than one row for S, 2020-01-01"):
        assembly.one_row_per_day(df.union(df.limit(1))).collect()
