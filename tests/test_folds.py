import datetime as dt

import pytest
from conftest import business_days, month_ends, rows
from pyspark.sql import functions as F

from tidewalk.config import FoldSettings
from tidewalk.operators import folds

SETTINGS = FoldSettings()


def frame_of(spark, days, series="A"):
    data = [(series, d, float(i)) for i, d in enumerate(days)]
    return folds.model_frame(spark.createDataFrame(data, "series_id string, trade_date date, fwd_ret_20d double"), ["fwd_ret_20d"])


def bounds_of(spark, ends, series="A"):
    return spark.createDataFrame([(series, e) for e in ends], "series_id string, expiry date")


def brute_force(days, ends, s=SETTINGS):
    """(train_end, test_end, embargo, train days, test days) by direct reading of the definition."""
    ends = [e for e in ends if e <= days[-1]]
    out = []
    for i in range(s.min_train_boundaries, len(ends) - 1):
        before = [d for d in days if d <= ends[i]]
        if len(before) - 1 - s.embargo_rows < 0:
            continue
        train = before[: len(before) - s.embargo_rows]
        test = [d for d in days if ends[i] < d <= ends[i + 1]]
        if len(train) >= s.min_train_rows and len(test) >= s.min_test_rows:
            out.append((ends[i], ends[i + 1], train[-1], train, test))
    return out


@pytest.fixture(scope="module")
def long_history(spark):
    days, ends = business_days(1800), month_ends(90)
    frame, bounds = frame_of(spark, days), bounds_of(spark, ends)
    built = folds.build_folds(frame, bounds).cache()
    yield days, ends, frame, built
    built.unpersist()


def test_no_lookahead_and_no_overlap(long_history):
    days, ends, frame, built = long_history
    ranged = folds.with_fold_ranges(frame, built)
    members = folds.fold_membership(ranged)
    spans = members.groupBy("fold_id").agg(
        F.max(F.when(F.col("role") == "train", F.col("trade_date"))).alias("last_train"),
        F.min(F.when(F.col("role") == "test", F.col("trade_date"))).alias("first_test"),
        F.max(F.when(F.col("role") == "test", F.col("trade_date"))).alias("last_test"),
    )
    checked = built.join(spans, "fold_id").collect()
    assert len(checked) > 0
    for f in checked:
        assert f.last_train <= f.train_end - dt.timedelta(days=SETTINGS.embargo_rows)
        assert f.test_start < f.first_test and f.last_test <= f.test_end
    keys = ["series_id", "fold_id", "trade_date"]
    train, test = (members.filter(F.col("role") == r).select(keys) for r in ("train", "test"))
    assert train.intersect(test).isEmpty()
    assert folds.fold_overlap(ranged, built).agg(F.sum("n_shared")).first()[0] == 0


def test_folds_and_membership_equal_the_definition(long_history):
    days, ends, frame, built = long_history
    expected = brute_force(days, ends)
    got = built.orderBy("fold_id").collect()
    assert [(f.fold_id, f.train_end, f.test_end, f.embargo_date, f.n_train, f.n_test) for f in got] == [
        (i, lo, hi, embargo, len(train), len(test)) for i, (lo, hi, embargo, train, test) in enumerate(expected)
    ]
    members = set(rows(folds.fold_membership(folds.with_fold_ranges(frame, built)).select("fold_id", "role", "trade_date")))
    assert members == {
        (i, role, d) for i, f in enumerate(expected) for role, ds in (("train", f[3]), ("test", f[4])) for d in ds
    }


def test_first_fold_starts_at_the_configured_boundary(long_history):
    _, ends, _, built = long_history
    assert built.filter("fold_id = 0").first().train_end == ends[SETTINGS.min_train_boundaries]


def test_short_history_gives_no_folds(spark):
    assert folds.build_folds(frame_of(spark, business_days(50)), bounds_of(spark, month_ends(90))).isEmpty()


def test_too_few_rows_drop_a_fold_and_ids_stay_dense(spark):
    """Sparse stretches fail the row floors; the survivors are renumbered."""
    days = [d for d in business_days(1800) if not (dt.date(2019, 3, 1) <= d <= dt.date(2019, 5, 20))]
    ends = month_ends(90)
    expected = brute_force(days, ends)
    got = folds.build_folds(frame_of(spark, days), bounds_of(spark, ends)).orderBy("fold_id").collect()
    assert [f.train_end for f in got] == [f[0] for f in expected]
    assert [f.fold_id for f in got] == list(range(len(expected)))
    assert dt.date(2019, 3, 31) not in {f.train_end for f in got}
    few = business_days(1800)[::15]
    assert folds.build_folds(frame_of(spark, few), bounds_of(spark, ends)).isEmpty()


def test_embargo_counts_surviving_rows(spark):
    """Thinning the days just before a boundary pushes the embargo further back."""
    days = business_days(1800)
    holes = [d for d in days if not (dt.date(2018, 1, 1) <= d <= dt.date(2018, 1, 26))]
    ends = month_ends(90)
    got = folds.build_folds(frame_of(spark, holes), bounds_of(spark, ends)).filter(F.col("train_end") == ends[24]).first()
    assert got.embargo_date == [d for d in holes if d <= ends[24]][-1 - SETTINGS.embargo_rows]


def test_series_fold_independently(spark):
    days, ends = business_days(900), month_ends(60)
    one = folds.build_folds(frame_of(spark, days), bounds_of(spark, ends)).drop("series_id")
    frames = frame_of(spark, days).union(frame_of(spark, days[:700], "B"))
    bounds = bounds_of(spark, ends).union(bounds_of(spark, ends, "B"))
    both = folds.build_folds(frames, bounds)
    assert rows(both.filter("series_id = 'A'").drop("series_id"), "fold_id") == rows(one, "fold_id")
    assert both.filter("series_id = 'B'").count() == len(brute_force(days[:700], ends))


def test_monthly_boundaries_keep_the_partial_last_month(spark):
    listed = [dt.date(2020, 1, 9), dt.date(2020, 1, 30), dt.date(2020, 2, 6), dt.date(2020, 2, 27), None]
    instruments = spark.createDataFrame(
        [("A", "T", e) for e in listed] + [("A", "T", listed[0]), ("A", "other", dt.date(2020, 1, 31))],
        "series_id string, ticker string, expiry date",
    )
    features = spark.createDataFrame([("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 2, 20))], "series_id string, trade_date date")
    got = rows(folds.monthly_boundaries(instruments, features, "T"), "expiry")
    assert got == [("A", dt.date(2020, 1, 30)), ("A", dt.date(2020, 2, 6))]


def test_model_frame_drops_null_and_nan(spark):
    days = business_days(4)
    df = spark.createDataFrame(
        [("A", days[0], 1.0), ("A", days[1], None), ("A", days[2], float("nan")), ("A", days[3], 2.0)],
        "series_id string, trade_date date, x double",
    )
    assert rows(folds.model_frame(df, ["x"]), "trade_date") == [("A", days[0], 1.0, 0), ("A", days[3], 2.0, 1)]
