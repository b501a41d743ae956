import datetime as dt

from conftest import rows

from tidewalk.operators import derivatives

DAY = dt.date(2020, 1, 1)
NEAR, MID, FAR, LAST = (dt.date(2020, m, 28) for m in (1, 2, 3, 4))


def chain(spark, *entries):
    return spark.createDataFrame(
        [("A", DAY, *entry) for entry in entries],
        "series_id string, trade_date date, expiry date, max_pain double, pe_oi long, ce_oi long, underlying_price double",
    )


def test_ties_go_to_the_nearer_expiry(spark):
    df = chain(spark, (LAST, 1.0, 5, 5, 1.0), (FAR, 1.0, 5, 5, 1.0), (MID, 1.0, 5, 5, 1.0), (NEAR, 1.0, 5, 5, 1.0))
    top = derivatives.top_by_liquidity(df, 3)
    assert {r.expiry for r in top.collect()} == {NEAR, MID, FAR}


def test_null_distance_keeps_its_weight(spark):
    df = chain(spark, (NEAR, 100.0, 5, 5, 110.0), (MID, 0.0, 15, 15, 110.0))
    assert derivatives.max_pain_distance(df).first().max_pain_dist_pct == 2.5


def test_ratio_of_sums(spark):
    df = chain(spark, (NEAR, 1.0, 1, 3, 1.0), (MID, 1.0, 1, 0, 1.0))
    assert derivatives.put_call_ratio(df).first().pcr == 0.6667
    assert derivatives.put_call_ratio(chain(spark, (NEAR, 1.0, 1, 0, 1.0))).first().pcr is None


def test_nearest_expiry_keeps_ties_and_ignores_null(spark):
    df = spark.createDataFrame(
        [("A", DAY, MID, 1.0), ("A", DAY, NEAR, 2.0), ("A", DAY, NEAR, 3.0), ("A", DAY, None, 4.0)],
        "series_id string, trade_date date, expiry date, basis double",
    )
    assert [r[-1] for r in rows(derivatives.nearest_expiry(df), "basis")] == [2.0, 3.0]


def test_top_k_is_cut_before_the_shuffle(spark, capsys):
    df = chain(spark, (NEAR, 1.0, 1, 3, 1.0))
    derivatives.top_by_liquidity(df).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_one_day_holding_most_contracts(spark):
    """40,000 contracts on one day beside a normal day: whole results, by brute force."""
    from pyspark.sql import functions as F

    hot = spark.range(40_000).select(
        F.lit("A").alias("series_id"), F.lit(DAY).alias("trade_date"),
        F.expr("date_add(date'2020-01-01', cast(id as int))").alias("expiry"), F.lit(100.0).alias("max_pain"),
        F.expr("id * 7919 % 40009").alias("pe_oi"), F.lit(1).cast("long").alias("ce_oi"),
        F.expr("100.0D + id % 10").alias("underlying_price"),
    )
    df = hot.repartition(16).union(chain(spark, (NEAR, 100.0, 5, 5, 110.0)).withColumn("trade_date", F.lit(NEAR)))
    top = sorted(((i * 7919 % 40009 + 1, i) for i in range(40_000)), reverse=True)[:3]
    expected = sum(oi * (i % 10) for oi, i in top) / sum(oi for oi, _ in top)
    got = {r.trade_date: r.max_pain_dist_pct for r in derivatives.max_pain_distance(df).collect()}
    assert got == {DAY: round(expected, 4), NEAR: 10.0}
    pcr = {r.trade_date: r.pcr for r in derivatives.put_call_ratio(df).collect()}
    ratio = sum(i * 7919 % 40009 for i in range(40_000)) / 40_000
    assert pcr[DAY] == int(ratio * 10_000 + 0.5) / 10_000
