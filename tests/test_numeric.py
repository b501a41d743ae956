import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tidewalk.functions import net_pct, net_ratio_pct, pct_change, ratio, round_f, skew_pct


def test_round_f_follows_binary_scaling(spark):
    values = [1.005, 0.285, 72.945, -1.005, 2.5, -2.5, 0.0, 1e12 + 0.125] + [i / 1000 for i in range(-3000, 3000, 7)]
    ours = spark.createDataFrame([(v,) for v in values], "x double").select(
        round_f(F.col("x"), 2).alias("two"), round_f(F.col("x"), 4).alias("four")
    ).toPandas()
    frame = pd.DataFrame({"i": range(len(values)), "x": values})
    theirs = duckdb.sql("SELECT round(x, 2) AS two, round(x, 4) AS four FROM frame ORDER BY i").df()
    assert ours.equals(theirs)
    assert ours.two[0] == 1.0


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(0, 0)], "a long, b long").select(
        ratio(F.col("a"), F.col("b")), net_pct(F.col("a"), F.col("b")), net_ratio_pct(F.col("a"), F.col("b")),
        pct_change(F.col("a"), F.col("b")), skew_pct(*[F.col("a")] * 4),
    )
    assert tuple(df.first()) == (None,) * 5


def test_net_and_skew(spark):
    df = spark.createDataFrame([(30, 10, 5, 15)], "cl long, cs long, pl long, ps long").select(
        net_pct(F.col("cl"), F.col("cs")), net_ratio_pct(F.col("cl"), F.col("cs")),
        skew_pct(F.col("cl"), F.col("cs"), F.col("pl"), F.col("ps")),
    )
    assert tuple(df.first()) == (50.0, 50.0, 50.0)
