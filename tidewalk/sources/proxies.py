"""Market tables derived from the star-schema test tables.

Every proxy has the schema in `schemas.SOURCE_TABLES`. `n_series` > 1 spreads the order keys over that many
series, so the same plans can be run for many instruments at once.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.config import MarketNames

NAMES = MarketNames()


# Declared, so that reading a table needs no job of its own to look at file footers.
TABLES = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _series_no(order_key: str, n_series: int) -> Column:
    number = F.lit(0) if n_series == 1 else F.expr(f"cast({order_key} div 4 % {n_series} as int)")
    return number.alias("series_no")


def _proxy(build):
    """Put `series_id` in place of the series number. Builders group by the number, so the pass over the big tables
    hashes integers and only the aggregated rows get names."""

    @wraps(build)
    def named(spark: SparkSession, sf_dir: str, n_series: int = 1) -> DataFrame:
        grouped = build(spark, sf_dir, n_series)
        name = F.lit(NAMES.ticker) if n_series == 1 else F.expr("concat('S', lpad(series_no, 3, '0'))")
        return grouped.select(name.alias("series_id"), *[c for c in grouped.columns if c != "series_no"])

    return named


def _orders(spark, sf_dir, n_series):
    return table(spark, sf_dir, "orders").select(
        "*",
        F.col("o_orderdate").cast("date").alias("trade_date"),
        _series_no("o_orderkey", n_series),
    )


def _lines(spark, sf_dir, n_series):
    return table(spark, sf_dir, "lineitem").select(
        "*",
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.col("l_quantity").cast("long").alias("quantity"),
        _series_no("l_orderkey", n_series),
    )


def index_levels_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy variant: one price series per order priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("series_id"),
            F.col("o_orderdate").cast("date").alias("trade_date"),
        )
        .agg(F.max("o_totalprice").alias("close"))
    )


def instruments_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderpriority").alias("series_id"), F.lit(NAMES.ticker).alias("ticker"),
            F.expr("last_day(add_months(cast(o_orderdate as date), o_orderkey % 3))").alias("expiry"),
        )
        .distinct()
    )


def index_levels_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price series per nation and market segment.

    The customer side joins by broadcast while it is under the session's threshold; beyond it the sort-merge
    join's hot customers are split by adaptive execution, since the aggregate above has its own exchange.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("trade_date"), "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("series_id"),
    )
    return (
        orders.join(customers, "c_custkey").groupBy("series_id", "trade_date").agg(F.max("o_totalprice").alias("close"))
    )


@_proxy
def market_activity_index(spark, sf_dir, n_series):
    levels = _orders(spark, sf_dir, n_series).groupBy("series_no", "trade_date").agg(
        F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low")
    )
    rows = F.array(
        F.struct(F.lit(NAMES.price_index).alias("index_name"), F.col("high").alias("close")),
        F.struct(F.lit(NAMES.volatility_index).alias("index_name"), F.col("low").alias("close")),
    )
    return levels.select("series_no", "trade_date", F.inline(rows))


# A line's bucket as one number of three-valued digits (0 no, 1 yes, 2 unknown) and one for the usual return flags, so that
# the join moves and the aggregation hashes a number and, for all but unusual flags, no text.
_FLAGS = ("N", "A", "R")
_BUCKET = f"""
    coalesce(int(l_linenumber % 3 <> 0), 2) + 3 * coalesce(int(l_linenumber = 7), 2) + 9 * coalesce(int(l_partkey % 2 = 0), 2)
    + 27 * coalesce(array_position(array({", ".join(f"'{f}'" for f in _FLAGS)}), l_returnflag), 0)
"""
_OTHER_FLAG = f"if(l_returnflag in {_FLAGS}, null, l_returnflag)"


@_proxy
def participant_activity(spark, sf_dir, n_series):
    """Contracts per day, participant and bucket.

    An order with very many lines skews the join; adaptive execution splits its partition, which is free here
    because the grouping has an exchange of its own. The orders of a partition are hashed, so that the lines, many times
    as many, are neither sorted nor spilled. Lines fill few of a day's 64 cells, so every day gets one more row
    in each, from its order keys; on the 5th and 6th of a month it does not, which leaves days with one side only.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.expr(f"cast({_BUCKET} as int) as bucket"),
        F.expr(f"{_OTHER_FLAG} as flag"), F.col("l_quantity").cast("long").alias("quantity"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("trade_date"))
    who, series_no = F.expr("cast(o_orderkey % 4 as int) as who"), _series_no("o_orderkey", n_series)
    cells = ["series_no", "trade_date", "who", "bucket", "flag"]
    days = orders.groupBy(series_no, "trade_date").agg(F.sum(F.expr("o_orderkey % 1000")).alias("base"))
    filled = days.where("day(trade_date) NOT IN (5, 6)").withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(63))))
    filled = filled.select(
        "series_no", "trade_date", F.expr("cell % 4 as who"),
        F.expr("""int(cell div 4 % 2 = 0) + 3 * int(cell div 8 % 4 = 1) + 9 * int(cell div 32 = 0)
               + 27 * element_at(array(1, 1, 2, 3), cast(cell div 8 % 4 as int) + 1) as bucket"""),
        F.lit(None).cast("string").alias("flag"), F.expr("(base + 37 * cell) % 1000 + 1 as quantity"),
    )
    return (
        lines.join(orders.hint("shuffle_hash"), "o_orderkey").select(series_no, "trade_date", who, "bucket", "flag", "quantity")
        .unionByName(filled)
        .groupBy(*cells)
        .agg(F.sum("quantity").alias("contracts"))
        .select(
            "series_no", "trade_date",
            F.expr("element_at(array('FII', 'Client', 'DII', 'Pro'), who + 1) as participant_type"),
            F.expr("if(bucket % 3 = 1, 'OI', 'VOL') as metric_type"),
            F.expr("if(bucket div 3 % 3 = 1, 'STOCK', 'INDEX') as asset_class"),
            F.expr("case bucket div 27 when 1 then 'NA' when 2 then 'CE' else 'PE' end as option_side"),
            F.expr("if(bucket div 9 % 3 = 1, 'long', 'short') as direction"),
            "contracts",
        )
    )


def _month_end(months_ahead: str) -> Column:
    return F.expr(f"last_day(add_months(trade_date, {months_ahead}))")


@_proxy
def options_analytics(spark, sf_dir, n_series):
    return (
        _lines(spark, sf_dir, n_series)
        .withColumn("expiry", _month_end("l_linenumber % 4"))
        .groupBy("series_no", "trade_date", "expiry")
        .agg(
            F.max("l_extendedprice").alias("max_pain"),
            F.expr("sum(if(l_linestatus = 'F', quantity, 0)) as pe_oi"),
            F.expr("sum(if(l_linestatus = 'O', quantity, 0)) as ce_oi"),
            F.min("l_extendedprice").alias("underlying_price"),
        )
        .select(
            "series_no", "trade_date", F.lit(NAMES.ticker).alias("ticker"),
            F.lit(NAMES.option_type).alias("instrument_type"), "expiry", "max_pain", "pe_oi", "ce_oi",
            "underlying_price",
        )
    )


@_proxy
def futures_analytics(spark, sf_dir, n_series):
    return (
        _lines(spark, sf_dir, n_series)
        .withColumn("expiry", _month_end("l_linenumber % 3"))
        .groupBy("series_no", "trade_date", "expiry")
        .agg(
            (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("basis"),
            F.max("l_discount").alias("cost_of_carry"),
            F.max("l_tax").alias("chng_oi_per"),
        )
        .select(
            "series_no", "trade_date", F.lit(NAMES.ticker).alias("ticker"),
            F.lit(NAMES.future_type).alias("instrument_type"), "expiry", "basis", "cost_of_carry", "chng_oi_per",
        )
    )


@_proxy
def fo_volatility(spark, sf_dir, n_series):
    discount, tax = F.max("l_discount"), F.max("l_tax")
    return _lines(spark, sf_dir, n_series).groupBy("series_no", "trade_date").agg(
        F.lit(NAMES.ticker).alias("ticker"),
        (discount / F.lit(10.0)).alias("underlying_daily_vol"),
        (tax / F.lit(10.0)).alias("futures_daily_vol"),
        ((discount + tax) / F.lit(20.0)).alias("applicable_daily_vol"),
    )


@_proxy
def market_activity_breadth(spark, sf_dir, n_series):
    def status(code):
        return F.count(F.when(F.col("o_orderstatus") == code, 1))

    return _orders(spark, sf_dir, n_series).groupBy("series_no", "trade_date").agg(
        status("F").alias("advances"), status("O").alias("declines"), status("P").alias("price_band_hits")
    )


@_proxy
def market_activity_summary(spark, sf_dir, n_series):
    return _orders(spark, sf_dir, n_series).groupBy("series_no", "trade_date").agg(
        F.max("o_totalprice").alias("traded_value_cr"),
        F.count(F.lit(1)).alias("num_trades"),
        F.min("o_totalprice").alias("market_cap_cr"),
    )


@_proxy
def fii_stats(spark, sf_dir, n_series):
    instrument = F.when(F.col("o_orderkey") % 2 == 0, NAMES.flow_instrument).otherwise("STOCK FUTURES")
    return (
        _orders(spark, sf_dir, n_series)
        .groupBy("series_no", "trade_date", instrument.alias("instrument"))
        .agg(
            F.max("o_totalprice").alias("buy_amount_cr"),
            F.min("o_totalprice").alias("sell_amount_cr"),
            F.sum(F.col("o_custkey") % 100).alias("buy_contracts"),
            F.sum(F.col("o_custkey") % 37).alias("sell_contracts"),
            F.max("o_totalprice").alias("oi_amount_cr"),
        )
    )


@_proxy
def instruments(spark, sf_dir, n_series):
    return (
        _lines(spark, sf_dir, n_series)
        .select("series_no", F.lit(NAMES.ticker).alias("ticker"), _month_end("l_linenumber % 3").alias("expiry"))
        .distinct()
    )


_BUILDERS = (
    market_activity_index, participant_activity, options_analytics, futures_analytics, fo_volatility,
    market_activity_breadth, market_activity_summary, fii_stats, instruments,
)


def market_tables(spark: SparkSession, sf_dir: str, n_series: int = 1) -> dict[str, DataFrame]:
    return {build.__name__: build(spark, sf_dir, n_series) for build in _BUILDERS}
