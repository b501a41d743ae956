import datetime as dt

import pytest
from conftest import business_days, rows
from pyspark.sql import functions as F

from tidewalk.operators import returns

DAYS = business_days(40)


def prices(spark, values, series="A"):
    return spark.createDataFrame(
        [(series, d, float(v)) for d, v in zip(DAYS, values)], "series_id string, trade_date date, close double"
    )


def test_last_row_has_no_return_but_a_zero_flag(spark):
    got = rows(returns.forward_returns(prices(spark, [100, 110, 99])), "trade_date")
    assert [r[3] for r in got] == [10.0, -10.0, None]
    assert [r[-1] for r in got] == [1, 0, 0]
    assert all(r[4] is None and r[5] is None for r in got)


def test_horizons_count_rows_not_days(spark):
    got = rows(returns.forward_returns(prices(spark, range(100, 125)), horizons=(5, 20)), "trade_date")
    assert got[0][3] == 5.0 and got[0][4] == 20.0
    assert got[5][4] is None and got[4][4] is not None


def test_series_do_not_leak_into_each_other(spark):
    both = prices(spark, [100, 110]).union(prices(spark, [50, 40], "B"))
    got = {(r[0], r[1]): r[3] for r in rows(returns.forward_returns(both))}
    assert got[("A", DAYS[0])] == 10.0 and got[("B", DAYS[0])] == -20.0 and got[("A", DAYS[1])] is None


def test_zero_price_gives_null_return(spark):
    got = rows(returns.forward_returns(prices(spark, [0, 5])), "trade_date")
    assert got[0][3] is None and got[0][-1] == 1


def test_repeated_day_is_an_error(spark):
    df = prices(spark, [1, 2]).union(prices(spark, [3]))
    with pytest.raises(Exception, match="more than one row"):
        returns.forward_returns(df).collect()
    with pytest.raises(Exception, match="more than one row"):
        returns.with_position(df).collect()


def test_backward_features_ignore_the_future(spark):
    df = prices(spark, [v * v % 37 + 1 for v in range(30)])
    cut = DAYS[20]
    whole = returns.lag_deltas(df, {"chg": "close"}).filter(F.col("trade_date") <= cut)
    known = returns.lag_deltas(df.filter(F.col("trade_date") <= cut), {"chg": "close"})
    assert rows(whole, "trade_date") == rows(known, "trade_date")


def test_partitioning_does_not_matter(spark):
    df = prices(spark, [v * v % 37 + 1 for v in range(30)])
    assert rows(returns.forward_returns(df.repartition(7)), "trade_date") == rows(
        returns.forward_returns(df.coalesce(1)), "trade_date"
    )


def test_index_levels_need_a_price_row_and_one_row_per_index(spark):
    schema = "series_id string, trade_date date, index_name string, close double"
    a, b, c = DAYS[:3]
    df = spark.createDataFrame(
        [("A", a, "P", 1.0), ("A", a, "V", 9.0), ("A", b, "P", None), ("A", c, "V", 8.0), ("A", a, "other", 5.0)], schema
    )
    assert rows(returns.index_levels(df, "P", "V"), "trade_date") == [("A", a, 1.0, 9.0), ("A", b, None, None)]
    twice = df.union(spark.createDataFrame([("A", a, "V", 9.5)], schema))
    with pytest.raises(Exception, match="more than one V row"):
        returns.index_levels(twice, "P", "V").collect()


def test_spread_annualises_over_252_days(spark):
    got = spark.range(1).select(returns.vol_spread(F.lit(20.0), F.lit(0.01))).first()[0]
    assert got == pytest.approx(20.0 - 252**0.5)
    assert dt.date(2016, 1, 1) == DAYS[0]
