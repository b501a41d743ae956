import datetime as dt

from conftest import rows

from tidewalk.operators import participants

DAY = dt.date(2020, 1, 1)
SCHEMA = (
    "series_id string, trade_date date, participant_type string, metric_type string, asset_class string, "
    "option_side string, direction string, contracts long"
)


def table(spark, *entries):
    return spark.createDataFrame([("A", DAY, *entry) for entry in entries], SCHEMA)


def test_one_sided_day_is_null_for_roles_and_full_for_the_pivot(spark):
    df = table(spark, ("FII", "OI", "INDEX", "NA", "long", 10))
    assert participants.role_net_pct(df).first().fii_fut_net_pct is None
    assert participants.participant_pivot(df).first().fii_oi_idx_fut_net_pct == 100.0


def test_base_counts_empty_buckets_as_zero_and_nets_them_to_null(spark):
    df = table(spark, ("DII", "VOL", "STOCK", "NA", "short", 4))
    base = participants.participant_base(df).first()
    assert (base.stk_fut_short, base.idx_fut_long, base.idx_pe_short) == (4, 0, 0)
    net = participants.participant_net(participants.participant_base(df)).first()
    assert (net.stk_fut_net_pct, net.idx_fut_net_pct, net.idx_opt_skew_pct) == (-100.0, None, None)


def test_skew(spark):
    df = table(
        spark, ("Pro", "OI", "INDEX", "CE", "long", 30), ("Pro", "OI", "INDEX", "CE", "short", 10),
        ("Pro", "OI", "INDEX", "PE", "long", 5), ("Pro", "OI", "INDEX", "PE", "short", 15),
    )
    assert participants.participant_pivot(df).first().pro_oi_idx_opt_skew_pct == 50.0


def test_single_pass_equals_the_two_separate_operators(spark, sf_dir):
    from tidewalk.sources.proxies import participant_activity

    df = participant_activity(spark, sf_dir, 4)
    keys = ["series_id", "trade_date"]
    both = participants.participant_pivot(df).join(participants.role_net_pct(df), keys, "left")
    one = participants.participant_features(df).select(*both.columns)
    assert rows(one, *keys) == rows(both, *keys)


def test_flow_stats_filter_the_instrument(spark):
    schema = (
        "series_id string, trade_date date, instrument string, buy_amount_cr double, sell_amount_cr double, "
        "buy_contracts long, sell_contracts long, oi_amount_cr double"
    )
    df = spark.createDataFrame(
        [("A", DAY, "INDEX FUTURES", 10.006, 4.0, 3, 1, 7.0), ("A", DAY, "other", 1.0, 1.0, 1, 1, 1.0)], schema
    )
    assert rows(participants.flow_stats(df, "INDEX FUTURES")) == [("A", DAY, 6.01, 50.0, 7.0)]


def test_lines_find_their_order_without_a_sort(spark, tmp_path):
    """Unknown line numbers, parts and flags, repeated and missing orders; the lines are hashed, not sorted, at any size."""
    from collections import Counter
    from datetime import datetime

    from tidewalk.sources import proxies

    day = datetime(1997, 1, 5)  # a day that gets no further rows
    orders = [(1, 1, "O", 1.0, day, "x"), (2, 1, "O", 1.0, day, "x"), (2, 1, "O", 1.0, day, "x"), (None, 1, "O", 1.0, day, "x")]
    numbers, parts, flags = (1, 3, 7, None), (1, 2, None), ("N", "A", "R", "x", "y", "", None)
    lines = [
        (key, part, 1, number, quantity, 1.0, 0.0, 0.0, flag, "O", day)
        for key in (1, 2, 5, None) for part in parts for number in numbers for flag in flags for quantity in (2.0, 3.0, None)
    ]
    for name, made in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(made, proxies.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    df = proxies.participant_activity(spark, str(tmp_path))
    expected = {}
    for key, part, _, number, quantity, *_, flag, _, _ in lines:
        for order in orders:
            if key is not None and order[0] == key:
                held = None if number is None else number % 3 != 0
                stock = None if number is None else number == 7
                cell = (key % 4, held, stock, flag, None if part is None else part % 2 == 0)
                expected.setdefault(cell, []).extend([] if quantity is None else [int(quantity)])
    who = ("FII", "Client", "DII", "Pro")
    want = Counter(
        ("NIFTY", day.date(), who[w], "OI" if held else "VOL", "STOCK" if stock else "INDEX",
         {"N": "NA", "A": "CE"}.get(flag, "PE"), "long" if bought else "short", sum(found) if found else None)
        for (w, held, stock, flag, bought), found in expected.items()
    )
    assert Counter(map(tuple, df.collect())) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
