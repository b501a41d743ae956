import pytest
from conftest import rows

from tidewalk import schemas
from tidewalk.plans.daily_features import daily_features
from tidewalk.sources import tables
from tidewalk.sources.proxies import market_tables


def test_proxies_have_the_declared_source_schemas(spark, sf_dir):
    for name, df in market_tables(spark, sf_dir).items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.SOURCE_TABLES[name]]


def test_features_from_written_tables_equal_features_from_proxies(spark, sf_dir, tmp_path):
    """The Parquet source, with and without a series column in the files."""
    proxies = market_tables(spark, sf_dir)
    for name, df in proxies.items():
        df.drop("series_id").write.parquet(f"{tmp_path}/{name}")
    read = tables.read_market_tables(spark, str(tmp_path), series_id="NIFTY")
    path = f"{tmp_path}/snapshot"
    tables.write_snapshot(daily_features(read), path)
    assert rows(tables.read_snapshot(spark, path), "trade_date") == rows(daily_features(proxies), "trade_date")


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path, capsys):
    proxies = market_tables(spark, sf_dir)
    for name in ("options_analytics", "futures_analytics"):
        proxies[name].write.parquet(f"{tmp_path}/{name}")
    for name in set(schemas.SOURCE_TABLES) - {"options_analytics", "futures_analytics"}:
        spark.createDataFrame([], schemas.SOURCE_TABLES[name]).write.parquet(f"{tmp_path}/{name}")
    daily_features(tables.read_market_tables(spark, str(tmp_path))).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(ticker,NIFTY), EqualTo(instrument_type,IDO)" in plan
    assert "EqualTo(instrument_type,IDF)" in plan
    assert "ReadSchema: struct<series_id:string,trade_date:date,ticker:string,instrument_type:string,pe_oi:bigint,ce_oi:bigint>" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_boundaries_round_trip(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([("A", dt.date(2020, 1, 30))], schemas.BOUNDARIES)
    df.write.parquet(f"{tmp_path}/b")
    assert rows(tables.read_boundaries(spark, f"{tmp_path}/b")) == rows(df)


def test_json_keeps_missing_numbers_missing(spark, tmp_path):
    df = spark.createDataFrame([("r", "m", "v", ["a"], None, 0.5, False, 0)], schemas.CHALLENGER)
    tables.write_json(df, f"{tmp_path}/j")
    assert rows(tables.read_json(spark, f"{tmp_path}/j", schemas.CHALLENGER)) == rows(df)


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_boundaries(spark, f"{tmp_path}/nowhere")


def test_working_files_live_under_the_configured_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert tables.new_working_path(spark, "x").startswith(f"{root}/tidewalk/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.working_root(Session())


def test_market_tables_read_over_jdbc_in_date_slices():
    """Only the read options are checked: no database is started for a test."""
    seen = []

    class Reader:
        def format(self, kind):
            assert kind == "jdbc"
            return self

        def options(self, **options):
            seen.append(options)
            return self

        def load(self):
            return object()

    class Session:
        read = Reader()

    got = tables.read_market_tables_jdbc(Session(), "jdbc:x", "2015-01-01", "2024-01-01", 8)
    assert set(got) == set(schemas.SOURCE_TABLES)
    sliced = [o for o in seen if o.get("partitionColumn") == "trade_date"]
    assert len(sliced) == 8 and all(o["numPartitions"] == "8" for o in seen)
    instruments = next(o for o in seen if o["dbtable"] == "nse.instruments")
    assert instruments["partitionColumn"] == "expiry" and "expiry date" in instruments["customSchema"]


def test_star_join_adds_no_exchange_beyond_one_per_side(spark, tmp_path, capsys):
    """Without broadcasts, as at scale: spine and sides are shuffled once by (series, day) for their own aggregation or
    ranking, and the joined rows once by series. The joins of the sides add nothing. The nearest expiry costs three
    exchanges more, for its minimum and a semi-join with it, which takes any number of ties on a day."""
    for name, schema in schemas.SOURCE_TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily_features(tables.read_market_tables(spark, str(tmp_path))).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    exchanges = [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line]
    by_series_only = [e for e in exchanges if "trade_date" not in e]
    assert len(by_series_only) == 1
    assert len(exchanges) == len(by_series_only) + 1 + 8 + 3
    assert plan.count("SortMergeJoin") == 8 + 1
