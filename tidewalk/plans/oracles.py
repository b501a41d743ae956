"""DuckDB equivalents of the registered queries.

Written from the definitions, not from the Spark plans: where a Spark operator uses running aggregates over a
timeline, its counterpart here is a plain range join or a correlated count. `RELATIONS` are named building blocks;
`_sql` puts the ones a query needs, in order, in front of it.
"""

from __future__ import annotations

import math
import re

from tidewalk.config import BASE_FEATURES, KNOWN_GAPS, REGISTERED_MODEL_NAME
from tidewalk.plans.catalog import GARCH, GARCH_RIVALS, LINE_INPUTS, MANY, PENALTIES, SHORT_FOLDS, TEST_GAPS
from tidewalk.plans.daily_features import DELTAS, PIVOT_COLUMNS
from tidewalk.schemas import SNAPSHOT

RELATIONS: dict[str, str] = {}


def _series(order_key: str, n_series: int) -> str:
    if n_series == 1:
        return "'NIFTY'"
    return f"'S' || lpad(CAST(({order_key} // 4) % {n_series} AS VARCHAR), 3, '0')"


def _month_end(months_ahead: str, day: str = "trade_date") -> str:
    return f"CAST(last_day({day} + to_months(CAST({months_ahead} AS INTEGER))) AS DATE)"


def _market(n: int, tag: str) -> None:
    """The proxy tables and the assembled features, for one series ('1') or many ('m')."""
    R = RELATIONS
    R[f"ord_{tag}"] = f"""
        SELECT *, CAST(o_orderdate AS DATE) AS trade_date, {_series('o_orderkey', n)} AS series_id FROM orders"""
    R[f"line_{tag}"] = f"""
        SELECT *, CAST(l_shipdate AS DATE) AS trade_date, CAST(l_quantity AS BIGINT) AS quantity,
               {_series('l_orderkey', n)} AS series_id
        FROM lineitem"""
    R[f"levels_{tag}"] = f"""
        SELECT series_id, trade_date, max(o_totalprice) AS close, min(o_totalprice) AS vix_close
        FROM ord_{tag} GROUP BY ALL"""
    R[f"part_{tag}"] = f"""
        SELECT o.series_id, o.trade_date,
               CASE o.o_orderkey % 4 WHEN 0 THEN 'FII' WHEN 1 THEN 'Client' WHEN 2 THEN 'DII' ELSE 'Pro' END AS who,
               CASE WHEN l_linenumber % 3 <> 0 THEN 'OI' ELSE 'VOL' END AS metric,
               CASE WHEN l_linenumber = 7 THEN 'STOCK' ELSE 'INDEX' END
                   || CASE l_returnflag WHEN 'N' THEN '_NA' WHEN 'A' THEN '_CE' ELSE '_PE' END AS kind,
               l_partkey % 2 = 0 AS is_long,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS contracts
        FROM lineitem JOIN ord_{tag} o ON o_orderkey = l_orderkey GROUP BY ALL
        UNION ALL
        SELECT series_id, trade_date, who, metric, kind, is_long, (base + 37 * cell) % 1000 + 1
        FROM (SELECT series_id, trade_date, CAST(sum(o_orderkey % 1000) AS BIGINT) AS base FROM ord_{tag}
              WHERE day(trade_date) NOT IN (5, 6) GROUP BY ALL),
             (SELECT w.i + 4 * h.i + 8 * k.i + 32 * l.i AS cell, who, metric, kind, is_long
              FROM (VALUES (0, 'FII'), (1, 'Client'), (2, 'DII'), (3, 'Pro')) w(i, who),
                   (VALUES (0, 'OI'), (1, 'VOL')) h(i, metric),
                   (VALUES (0, 'INDEX_NA'), (1, 'STOCK_NA'), (2, 'INDEX_CE'), (3, 'INDEX_PE')) k(i, kind),
                   (VALUES (0, true), (1, false)) l(i, is_long))"""
    buckets = {"idx_fut": "INDEX_NA", "stk_fut": "STOCK_NA", "idx_ce": "INDEX_CE", "idx_pe": "INDEX_PE"}
    sums = ",\n".join(
        f"CAST(coalesce(sum(contracts) FILTER (kind = '{kind}' AND is_long = {flag}), 0) AS BIGINT) AS {name}_{side}"
        for name, kind in buckets.items() for side, flag in (("long", "true"), ("short", "false"))
    )
    R[f"pbase_{tag}"] = f"""
        SELECT series_id, trade_date, who AS participant_type, metric AS metric_type, {sums}
        FROM part_{tag} GROUP BY ALL"""
    R[f"pnet_{tag}"] = f"""
        SELECT series_id, trade_date, participant_type, metric_type,
               round(100.0::DOUBLE * (idx_fut_long - idx_fut_short) / nullif(idx_fut_long + idx_fut_short, 0), 2)
                   AS idx_fut_net_pct,
               round(100.0::DOUBLE * (stk_fut_long - stk_fut_short) / nullif(stk_fut_long + stk_fut_short, 0), 2)
                   AS stk_fut_net_pct,
               round(100.0::DOUBLE * (idx_ce_long - idx_ce_short - idx_pe_long + idx_pe_short)
                   / nullif(idx_ce_long + idx_ce_short + idx_pe_long + idx_pe_short, 0), 2) AS idx_opt_skew_pct
        FROM pbase_{tag}"""
    wanted = sorted({"fii_oi_idx_fut_net_pct", "client_oi_idx_fut_net_pct", *PIVOT_COLUMNS.values()})
    picks = ",\n".join(
        f"any_value({measure}) FILTER (lower(participant_type) = '{who}' AND lower(metric_type) = '{metric}') AS {name}"
        for name in wanted for who, metric, measure in [name.split("_", 2)]
    )
    R[f"ppivot_{tag}"] = f"SELECT series_id, trade_date, {picks} FROM pnet_{tag} GROUP BY ALL"
    roles = {"fii_fut": ("FII", "INDEX_NA"), "client_fut": ("Client", "INDEX_NA"), "fii_pe": ("FII", "INDEX_PE")}
    held = ",\n".join(
        f"sum(contracts) FILTER (who = '{who}' AND kind = '{kind}' AND {'' if long else 'NOT '}is_long) AS {name}_{side}"
        for name, (who, kind) in roles.items() for side, long in (("l", True), ("s", False))
    )
    shares = ",\n".join(
        f"round(CAST({r}_l - {r}_s AS BIGINT) / nullif(CAST({r}_l + {r}_s AS BIGINT), 0) * 100, 2) AS {r}_net_pct"
        for r in roles
    )
    R[f"roles_{tag}"] = f"""
        SELECT series_id, trade_date, {shares} FROM (
            SELECT series_id, trade_date, {held} FROM part_{tag}
            WHERE metric = 'OI' AND who IN ('FII', 'Client') AND kind LIKE 'INDEX%' GROUP BY ALL)"""
    R[f"opt_{tag}"] = f"""
        SELECT series_id, trade_date, {_month_end('l_linenumber % 4')} AS expiry,
               max(l_extendedprice) AS max_pain, min(l_extendedprice) AS underlying_price,
               CAST(coalesce(sum(quantity) FILTER (l_linestatus = 'F'), 0) AS BIGINT) AS pe_oi,
               CAST(coalesce(sum(quantity) FILTER (l_linestatus = 'O'), 0) AS BIGINT) AS ce_oi
        FROM line_{tag} GROUP BY ALL"""
    R[f"pcr_{tag}"] = f"""
        SELECT series_id, trade_date,
               round(CAST(sum(pe_oi) AS BIGINT) / nullif(CAST(sum(ce_oi) AS BIGINT), 0), 4) AS pcr
        FROM opt_{tag} GROUP BY ALL"""
    R[f"top3_{tag}"] = f"""
        SELECT *, pe_oi + ce_oi AS open_interest,
               CAST(row_number() OVER (PARTITION BY series_id, trade_date ORDER BY pe_oi + ce_oi DESC, expiry)
                   AS INTEGER) AS liquidity_rank
        FROM opt_{tag} QUALIFY liquidity_rank <= 3"""
    R[f"pain_{tag}"] = f"""
        SELECT series_id, trade_date,
               round(sum((underlying_price - max_pain) / nullif(max_pain, 0) * 100 * open_interest)
                   / nullif(CAST(sum(open_interest) AS BIGINT), 0), 4) AS max_pain_dist_pct
        FROM top3_{tag} GROUP BY ALL"""
    R[f"fut_{tag}"] = f"""
        SELECT series_id, trade_date, {_month_end('l_linenumber % 3')} AS expiry,
               max(l_extendedprice) - min(l_extendedprice) AS basis, max(l_discount) AS cost_of_carry,
               max(l_tax) AS chng_oi_per
        FROM line_{tag} GROUP BY ALL"""
    R[f"near_{tag}"] = f"""
        SELECT f.* FROM fut_{tag} f
        JOIN (SELECT series_id, trade_date, min(expiry) AS expiry FROM fut_{tag} GROUP BY ALL)
        USING (series_id, trade_date, expiry)"""
    R[f"vol_{tag}"] = f"""
        SELECT series_id, trade_date, max(l_discount) / 10 AS underlying_daily_vol, max(l_tax) / 10 AS futures_daily_vol,
               (max(l_discount) + max(l_tax)) / 20 AS applicable_daily_vol
        FROM line_{tag} GROUP BY ALL"""
    R[f"breadth_{tag}"] = f"""
        SELECT series_id, trade_date, count(*) FILTER (o_orderstatus = 'F') AS advances,
               count(*) FILTER (o_orderstatus = 'O') AS declines, count(*) FILTER (o_orderstatus = 'P') AS price_band_hits,
               round(CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE)
                   / nullif(count(*) FILTER (o_orderstatus = 'O'), 0), 4) AS adv_decl_ratio
        FROM ord_{tag} GROUP BY ALL"""
    R[f"sums_{tag}"] = f"""
        SELECT series_id, trade_date, max(o_totalprice) AS traded_value_cr, count(*) AS num_trades,
               min(o_totalprice) AS market_cap_cr
        FROM ord_{tag} GROUP BY ALL"""
    R[f"flow_{tag}"] = f"""
        SELECT series_id, trade_date, round(max(o_totalprice) - min(o_totalprice), 2) AS fii_net_flow_cr,
               round(CAST(sum(o_custkey % 100) - sum(o_custkey % 37) AS BIGINT)
                   / nullif(CAST(sum(o_custkey % 100) + sum(o_custkey % 37) AS BIGINT), 0) * 100, 2)
                   AS fii_stats_fut_net_pct,
               max(o_totalprice) AS fii_stats_oi_net_cr
        FROM ord_{tag} WHERE o_orderkey % 2 = 0 GROUP BY ALL"""
    renamed = ", ".join(f"{source} AS {name}" for name, source in PIVOT_COLUMNS.items())
    R[f"pcols_{tag}"] = f"""
        SELECT series_id, trade_date, {renamed},
               round(fii_oi_idx_fut_net_pct - client_oi_idx_fut_net_pct, 2) AS fii_client_divergence
        FROM ppivot_{tag}"""
    R[f"joined_{tag}"] = f"""
        SELECT l.close AS nifty_close, l.* EXCLUDE (close), v.* EXCLUDE (series_id, trade_date),
               b.* EXCLUDE (series_id, trade_date), s.* EXCLUDE (series_id, trade_date), pcr, max_pain_dist_pct, basis,
               cost_of_carry, chng_oi_per AS fut_chng_oi_pct, r.* EXCLUDE (series_id, trade_date),
               c.* EXCLUDE (series_id, trade_date), f.* EXCLUDE (series_id, trade_date)
        FROM levels_{tag} l
        LEFT JOIN vol_{tag} v USING (series_id, trade_date)
        LEFT JOIN breadth_{tag} b USING (series_id, trade_date)
        LEFT JOIN sums_{tag} s USING (series_id, trade_date)
        LEFT JOIN pcr_{tag} p USING (series_id, trade_date)
        LEFT JOIN pain_{tag} m USING (series_id, trade_date)
        LEFT JOIN near_{tag} n USING (series_id, trade_date)
        LEFT JOIN roles_{tag} r USING (series_id, trade_date)
        LEFT JOIN pcols_{tag} c USING (series_id, trade_date)
        LEFT JOIN flow_{tag} f USING (series_id, trade_date)"""


def _returns(source: str, price: str = "close", horizons=(1, 5, 20)) -> str:
    ahead = ",\n".join(
        f"round((lead({price}, {n}) OVER w - {price}) / nullif({price}, 0) * 100, 4) AS fwd_ret_{n}d" for n in horizons
    )
    return f"""SELECT *, {ahead}, CASE WHEN lead({price}) OVER w > {price} THEN 1 ELSE 0 END AS up_1d
        FROM {source} WINDOW w AS (PARTITION BY series_id ORDER BY trade_date)"""


def _patched(source: str, gaps) -> str:
    """Nested selects, one per gap; neighbour means come from the relation before that patch."""
    sql = f"SELECT * FROM {source}"
    for gap in gaps:
        days = ", ".join(f"DATE '{d}'" for d in gap.neighbours)
        hit = f"x.trade_date = DATE '{gap.trade_date}' AND x.{gap.guard} IS NULL"
        means = ", ".join(f"avg({c}) AS m_{c}" for c in gap.columns)
        swaps = ", ".join(f"CASE WHEN {hit} THEN m_{c} ELSE x.{c} END AS {c}" for c in gap.columns)
        sql = f"""
            SELECT x.* REPLACE ({swaps}) FROM ({sql}) x
            LEFT JOIN (SELECT series_id, {means} FROM ({sql}) WHERE trade_date IN ({days}) GROUP BY ALL) g
            USING (series_id)"""
    return sql


def _deltas(source: str) -> str:
    changes = ", ".join(f"{c} - lag({c}, 5) OVER w AS {name}" for name, c in DELTAS.items())
    return f"SELECT *, {changes} FROM {source} WINDOW w AS (PARTITION BY series_id ORDER BY trade_date)"


def _features(tag: str, gaps) -> None:
    RELATIONS[f"ret_{tag}"] = _returns(f"joined_{tag}", "nifty_close")
    RELATIONS[f"patch_{tag}"] = _patched(f"ret_{tag}", gaps)
    RELATIONS[f"delta_{tag}"] = _deltas(f"patch_{tag}")
    columns = [
        "vix_close - applicable_daily_vol * sqrt(252.0::DOUBLE) * 100 AS vix_realized_spread"
        if name == "vix_realized_spread" else name
        for name in SNAPSHOT.fieldNames()
    ]
    RELATIONS[f"daily_{tag}"] = f"SELECT {', '.join(columns)} FROM delta_{tag}"


_market(1, "1")
_market(MANY, "m")
_features("1", KNOWN_GAPS)
_features("m", (*KNOWN_GAPS, *TEST_GAPS))

_KEYS = "model_name, feature_variant, series_id, fold_id"
_EMBARGO, _WARMUP, _MIN_TRAIN, _MIN_TEST = 20, 24, 100, 5


def _folds(frame: str, bounds: str, embargo: int, warmup: int, min_train: int, min_test: int) -> str:
    """Folds by counting: every size is a correlated count over the frame."""
    return f"""
        SELECT series_id, CAST(row_number() OVER (PARTITION BY series_id ORDER BY lo) - 1 AS INTEGER) AS fold_id,
               lo AS train_end, lo AS test_start, hi AS test_end, e.trade_date AS embargo_date,
               (SELECT count(*) FROM {frame} f WHERE f.series_id = b.series_id AND f.trade_date <= e.trade_date) AS n_train,
               (SELECT count(*) FROM {frame} f
                WHERE f.series_id = b.series_id AND f.trade_date > lo AND f.trade_date <= hi) AS n_test
        FROM (
            SELECT series_id, expiry AS lo, lead(expiry) OVER w AS hi, row_number() OVER w - 1 AS i,
                   (SELECT max(pos) FROM {frame} f WHERE f.series_id = v.series_id AND f.trade_date <= v.expiry) AS p
            FROM {bounds} v
            WHERE expiry <= (SELECT max(trade_date) FROM {frame} f WHERE f.series_id = v.series_id)
            WINDOW w AS (PARTITION BY series_id ORDER BY expiry)) b
        JOIN {frame} e USING (series_id)
        WHERE e.pos = b.p - {embargo} AND hi IS NOT NULL AND i >= {warmup}
          AND n_train >= {min_train} AND n_test >= {min_test}"""


RELATIONS |= {
    "priority": """
        SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS trade_date, max(o_totalprice) AS close
        FROM orders GROUP BY ALL""",
    "segment": """
        SELECT c_nationkey || '-' || c_mktsegment AS series_id, CAST(o_orderdate AS DATE) AS trade_date,
               max(o_totalprice) AS close
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL""",
    "pret": _returns("priority"),
    "pfeat": """
        SELECT *, close - lag(close, 5) OVER (PARTITION BY series_id ORDER BY trade_date) AS close_chg_5d FROM pret""",
    "pframe": """
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY trade_date) - 1 AS pos FROM pfeat
        WHERE fwd_ret_20d IS NOT NULL AND close_chg_5d IS NOT NULL""",
    "pbounds": f"""
        SELECT series_id, max(expiry) AS expiry FROM (
            SELECT o_orderpriority AS series_id,
                   {_month_end('o_orderkey % 3', 'CAST(o_orderdate AS DATE)')} AS expiry,
                   min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority) AS lo,
                   max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority) AS hi
            FROM orders)
        WHERE expiry >= lo AND expiry <= hi GROUP BY series_id, year(expiry), month(expiry)""",
    "pfolds": _folds("pframe", "pbounds", _EMBARGO, _WARMUP, _MIN_TRAIN, _MIN_TEST),
    "members": """
        SELECT series_id, trade_date, fold_id, 'train' AS role FROM pframe JOIN pfolds USING (series_id)
        WHERE trade_date <= embargo_date
        UNION ALL
        SELECT series_id, trade_date, fold_id, 'test' FROM pframe JOIN pfolds USING (series_id)
        WHERE trade_date > test_start AND trade_date <= test_end""",
    "xy": " UNION ALL ".join(
        f"SELECT series_id, trade_date, fwd_ret_20d AS y, {c} AS x, '{c}' AS feature_variant FROM pframe"
        for c in LINE_INPUTS
    ),
    "lines": """
        SELECT series_id, feature_variant, fold_id, arg_max(y, trade_date) AS newest, regr_slope(y, x) AS slope,
               regr_intercept(y, x) AS intercept
        FROM xy JOIN members USING (series_id, trade_date) WHERE role = 'train' GROUP BY ALL""",
    "predictions": """
        SELECT m.model_name, feature_variant, series_id, fold_id, trade_date,
               round(CASE m.model_name WHEN 'last_label' THEN newest WHEN 'moved_label' THEN newest + x / 10000.0::DOUBLE
                   ELSE intercept + slope * x END, 6) AS prediction,
               y AS label
        FROM xy JOIN members USING (series_id, trade_date)
        JOIN lines USING (series_id, feature_variant, fold_id)
        CROSS JOIN (VALUES ('last_label'), ('moved_label'), ('least_squares')) m(model_name)
        WHERE role = 'test'""",
    "firsts": f"""
        SELECT *, first_value(prediction) OVER w AS p0, first_value(label) OVER w AS y0 FROM predictions
        WINDOW w AS (PARTITION BY {_KEYS} ORDER BY trade_date)""",
    "flat": f"""
        SELECT {_KEYS}, bool_and(abs(prediction - p0) <= 1e-8 + 1e-5 * abs(p0)) AS flat_prediction,
               bool_and(abs(label - y0) <= 1e-8 + 1e-5 * abs(y0)) AS flat_label
        FROM firsts GROUP BY ALL""",
    "ranks": f"""
        SELECT a.*, (SELECT count(*) FILTER (b.prediction < a.prediction) + (count(*) FILTER (b.prediction = a.prediction) + 1) / 2
                     FROM predictions b WHERE b.model_name = a.model_name AND b.feature_variant = a.feature_variant
                       AND b.series_id = a.series_id AND b.fold_id = a.fold_id) AS rp,
               (SELECT count(*) FILTER (b.label < a.label) + (count(*) FILTER (b.label = a.label) + 1) / 2
                     FROM predictions b WHERE b.model_name = a.model_name AND b.feature_variant = a.feature_variant
                       AND b.series_id = a.series_id AND b.fold_id = a.fold_id) AS ry
        FROM predictions a""",
    "corrs": f"""
        SELECT {_KEYS}, CASE WHEN NOT (flat_prediction OR flat_label) THEN corr(prediction, label) END AS ic_pearson,
               CASE WHEN NOT (flat_prediction OR flat_label) THEN corr(rp, ry) END AS ic_spearman
        FROM ranks JOIN flat USING ({_KEYS}) GROUP BY {_KEYS}, flat_prediction, flat_label HAVING count(*) > 2""",
    "errors": f"""
        SELECT {_KEYS}, count(*) AS n_test,
               CASE WHEN count(*) > 2 THEN sqrt(avg(pow(prediction - label, 2))) END AS rmse,
               CASE WHEN count(*) > 2 THEN avg(CASE WHEN sign(prediction) = sign(label) THEN 1.0::DOUBLE ELSE 0 END) END
                   AS dir_acc
        FROM predictions GROUP BY ALL""",
    "results": f"SELECT * FROM errors LEFT JOIN corrs USING ({_KEYS})",
    "summary0": """
        SELECT model_name, feature_variant, count(ic_pearson) AS n_folds, avg(ic_pearson) AS ic,
               avg(ic_spearman) AS ics, stddev_samp(ic_pearson) AS sd,
               count(*) FILTER (ic_pearson > 0) / count(*) AS pos, avg(rmse) AS r, avg(dir_acc) AS d
        FROM results GROUP BY ALL""",
    "summary": """
        SELECT model_name, feature_variant, n_folds, round(ic, 6) AS mean_ic_pearson, round(ics, 6) AS mean_ic_spearman,
               CASE WHEN n_folds > 1 AND sd > 0 THEN round(ic / (sd / sqrt(n_folds)), 6) END AS ic_t_stat,
               round(pos, 6) AS positive_fold_pct, round(r, 6) AS mean_rmse, round(d, 6) AS mean_dir_acc,
               coalesce(mean_ic_pearson >= 0.05 AND positive_fold_pct >= 0.55, false) AS meets_threshold,
               'run-' || model_name || '__' || feature_variant AS run_id
        FROM summary0""",
    "registry": f"""
        SELECT '{REGISTERED_MODEL_NAME}' AS name,
               CAST(row_number() OVER (ORDER BY model_name, feature_variant) AS INTEGER) AS version,
               CASE WHEN version % 2 = 1 THEN 'Production' ELSE 'Archived' END AS stage, mean_ic_pearson AS tag_ic
        FROM summary""",
    "production": "SELECT * FROM registry WHERE stage = 'Production' ORDER BY version DESC LIMIT 1",
    "best": """
        SELECT * FROM summary ORDER BY meets_threshold DESC, mean_ic_pearson DESC NULLS LAST, model_name, feature_variant
        LIMIT 1""",
    "rets": """
        SELECT series_id, trade_date, pos,
               ln(close) - ln(lag(close) OVER (PARTITION BY series_id ORDER BY trade_date)) AS log_ret
        FROM pframe""",
    "resid": f"SELECT series_id, trade_date, pos, log_ret * 100 - {GARCH.mu} AS e FROM rets WHERE pos > 0",
    "backcast": """
        SELECT series_id, sum(e * e * pow(0.94::DOUBLE, pos - 1)) / sum(pow(0.94::DOUBLE, pos - 1)) AS v0
        FROM resid WHERE pos <= 75 GROUP BY ALL""",
    # Variance of row `pos`, one row past the end included; a fold's path is a prefix of its series' path unless
    # the fold is shorter than the start-up window, which needs 75 returns and folds have at least 99.
    "variance": f"""
        SELECT series_id, 1::BIGINT AS pos, {GARCH.omega} + ({GARCH.alpha} + {GARCH.beta}) * v0 AS v FROM backcast
        UNION ALL
        SELECT series_id, p.pos + 1, {GARCH.omega} + {GARCH.alpha} * r.e * r.e + {GARCH.beta} * p.v
        FROM variance p JOIN resid r USING (series_id, pos)""",
    "path": """
        SELECT series_id, trade_date, pos, sqrt(v) / 100 AS sigma,
               sqrt(v) / 100 - lag(sqrt(v) / 100) OVER (PARTITION BY series_id ORDER BY pos) AS chg
        FROM variance JOIN resid USING (series_id, pos)""",
    "state": """
        SELECT f.series_id, f.fold_id, p.sigma AS last_sigma, n.v AS v1 FROM pfolds f
        JOIN path p ON p.series_id = f.series_id AND p.trade_date = f.embargo_date
        JOIN variance n ON n.series_id = p.series_id AND n.pos = p.pos + 1""",
    "ahead": """
        SELECT series_id, fold_id, trade_date,
               row_number() OVER (PARTITION BY series_id, fold_id ORDER BY trade_date) AS h
        FROM members WHERE role = 'test'""",
    "forecast0": f"""
        SELECT series_id, fold_id, trade_date, h, last_sigma,
               sqrt(v1 * pow({GARCH.alpha + GARCH.beta}::DOUBLE, h - 1)
                   + {GARCH.omega} * (1 - pow({GARCH.alpha + GARCH.beta}::DOUBLE, h - 1))
                     / (1 - {GARCH.alpha + GARCH.beta}::DOUBLE)) / 100 AS sigma
        FROM ahead JOIN state USING (series_id, fold_id)""",
    "forecast": """
        SELECT series_id, fold_id, trade_date, sigma,
               sigma - coalesce(lag(sigma) OVER (PARTITION BY series_id, fold_id ORDER BY h), last_sigma) AS chg
        FROM forecast0""",
    "rivals": "SELECT * FROM (VALUES " + ", ".join(
        f"('loglik_{n}', {p.mu}::DOUBLE, {p.omega}::DOUBLE, {p.alpha}::DOUBLE, {p.beta}::DOUBLE, {p.nu}::DOUBLE)"
        for n, p in enumerate(GARCH_RIVALS, 1)
    ) + ") r(rival, mu, omega, alpha, beta, nu)",
    "rivals_resid": "SELECT rival, series_id, trade_date, pos, log_ret * 100 - mu AS e FROM rets, rivals WHERE pos > 0",
    "rivals_past": """
        SELECT rival, series_id, sum(e * e * pow(0.94::DOUBLE, pos - 1)) / sum(pow(0.94::DOUBLE, pos - 1)) AS v0
        FROM rivals_resid WHERE pos <= 75 GROUP BY ALL""",
    # A fold has at least 99 returns, so its variances are the first ones of its series.
    "rivals_variance": """
        SELECT rival, series_id, 1::BIGINT AS pos, omega + (alpha + beta) * v0 AS v FROM rivals_past JOIN rivals USING (rival)
        UNION ALL
        SELECT rival, series_id, p.pos + 1, r.omega + r.alpha * d.e * d.e + r.beta * p.v
        FROM rivals_variance p JOIN rivals_resid d USING (rival, series_id, pos) JOIN rivals r USING (rival)""",
    "rivals_loglik": f"""
        SELECT rival, series_id, trade_date,
               lgamma((nu + 1) / 2) - lgamma(nu / 2) - 0.5 * ln({math.pi!r}::DOUBLE * (nu - 2)) - 0.5 * ln(v)
                   - (nu + 1) / 2 * ln(1 + e * e / (v * (nu - 2))) AS l
        FROM rivals_variance JOIN rivals_resid USING (rival, series_id, pos) JOIN rivals USING (rival)""",
    "dframe": f"""
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY trade_date) - 1 AS pos FROM daily_1
        WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ['fwd_ret_20d', *BASE_FEATURES])}""",
    "sframe": f"""
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY trade_date) - 1 AS pos
        FROM ({_returns('segment', horizons=(5,))}) WHERE fwd_ret_5d IS NOT NULL""",
    "sbounds": """
        SELECT series_id, max(trade_date) AS expiry FROM segment
        GROUP BY series_id, date_trunc('month', trade_date)""",
}


def _needed(sql: str) -> set[str]:
    return {name for name in RELATIONS if re.search(rf"\b{name}\b", sql)}


def _sql(final: str) -> str:
    """`final` behind the relations it uses, directly or not, in definition order."""
    found, todo = set(), _needed(final)
    while todo:
        found |= todo
        todo = set().union(*(_needed(RELATIONS[name]) for name in todo)) - found
    ordered = [name for name in RELATIONS if name in found]
    if not ordered:
        return final
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in ordered) + "\n" + final


_DAILY = f"SELECT {', '.join(SNAPSHOT.fieldNames())}"
_GARCH8 = "round(sigma, 8) AS garch_sigma, round(chg, 8) AS garch_sigma_chg"
_REPORT = """SELECT model_name AS model, feature_variant, mean_ic_pearson, positive_fold_pct, ic_t_stat, n_folds,
    meets_threshold,
    row_number() OVER (ORDER BY mean_ic_pearson DESC NULLS LAST, model_name, feature_variant) AS place FROM summary"""
_gap_columns = ["fii_fut_net_pct", "client_fut_net_pct", "fii_pe_net_pct", "adv_decl_ratio", "pcr"]
_missing = ", ".join(
    f"CASE WHEN ({c} IS NULL AND day(trade_date) <> 1) {'OR day(trade_date) = 13' if c == 'basis' else ''} THEN '{c}' END"
    for c in BASE_FEATURES
)
_complete = " AND ".join(f"{c} IS NOT NULL" for c in BASE_FEATURES)


def _stump(rows: str, keys: str) -> str:
    """The best single split on x for the y of some rows: the threshold and the two means, by keys."""
    by, using = (f"PARTITION BY {keys}", f"GROUP BY {keys}") if keys else ("", "")
    columns = f"{keys}, " if keys else ""
    return f"""
        SELECT {columns}arg_max(x, score) AS cut, arg_max(sl / nl, score) AS low, arg_max((s - sl) / (n - nl), score) AS high
        FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) AS score FROM (
            SELECT {columns}x, sum(c) OVER ({by} ORDER BY x) AS nl, sum(t) OVER ({by} ORDER BY x) AS sl,
                   sum(c) OVER ({by}) AS n, sum(t) OVER ({by}) AS s
            FROM (SELECT {columns}x, count(*) AS c, sum(y) AS t FROM ({rows}) GROUP BY ALL))
        WHERE nl < n) {using}"""


_stump_rows = """
    SELECT train_end, month(trade_date) AS x, fwd_ret_20d AS y
    FROM pfolds JOIN members USING (series_id, fold_id) JOIN pframe USING (series_id, trade_date)
    WHERE role = 'train'"""
_stump_scores = f"""
    SELECT series_id, trade_date, round(CASE WHEN month(trade_date) <= cut THEN low ELSE high END, 6) AS prediction
    FROM pfeat, ({_stump('SELECT month(trade_date) AS x, fwd_ret_20d AS y FROM pframe', '')}) WHERE day(trade_date) <> 13"""



def _penalised(rows: str) -> str:
    """One penalised split of residuals y by x: the threshold and both leaf values."""
    l1, l2 = PENALTIES
    value = "sign(sum(y) FILTER ({0})) * greatest(abs(sum(y) FILTER ({0})) - {1}, 0) / (count(*) FILTER ({0}) + {2})"
    return f"""
        SELECT any_value(cut) AS cut, {value.format('x <= cut', l1, l2)} AS low, {value.format('x > cut', l1, l2)} AS high
        FROM ({rows}), ({_stump(rows, '')})"""


_residuals = "SELECT month(trade_date) AS x, fwd_ret_20d - avg(fwd_ret_20d) OVER () AS y FROM pframe"
_first_round = _penalised(_residuals)
_second_round = _penalised(
    f"SELECT r.x, r.y - 0.5 * CASE WHEN r.x <= w.cut THEN w.low ELSE w.high END AS y FROM ({_residuals}) r, ({_first_round}) w"
)


def _no_difference(model: str, variant: str) -> str:
    """Every complete day, scored alike in both ways."""
    return f"""
        SELECT series_id, trade_date, 'fwd_ret_20d' AS target, '{model}' AS model_name, '{variant}' AS feature_variant,
               0::DOUBLE AS difference
        FROM daily_1 WHERE {_complete}"""


FINAL = {
    "forward_returns": _returns("(SELECT series_id, trade_date, close FROM levels_1)"),
    "forward_returns_many_series": _returns("segment"),
    "next_row_position": """
        SELECT series_id, trade_date, row_number() OVER w - 1 AS pos, lead(trade_date) OVER w AS next_1,
               lead(trade_date, 5) OVER w AS next_5, lead(trade_date, 20) OVER w AS next_20
        FROM priority WINDOW w AS (PARTITION BY series_id ORDER BY trade_date)""",
    "participant_base": "SELECT * FROM pbase_1",
    "participant_net_pct": "SELECT * FROM pnet_1",
    "participant_pivot": "SELECT * FROM ppivot_1",
    "role_net_pct": "SELECT * FROM roles_1",
    "divergence": "SELECT series_id, trade_date, fii_client_divergence FROM pcols_1",
    "put_call_ratio": "SELECT * FROM pcr_1",
    "top3_by_liquidity": "SELECT series_id, trade_date, expiry, open_interest, liquidity_rank FROM top3_1",
    "max_pain_distance": "SELECT * FROM pain_1",
    "nearest_expiry_semi": "SELECT * FROM near_1",
    "breadth_ratio": "SELECT * FROM breadth_1",
    "fii_flow": "SELECT * FROM flow_1",
    "star_join": """
        SELECT series_id, trade_date, nifty_close, vix_close, pcr, max_pain_dist_pct, basis, underlying_daily_vol,
               advances, num_trades, fii_fut_net_pct, fii_net_flow_cr
        FROM joined_1""",
    "fill_columns": """
        SELECT l.series_id, l.trade_date, close,
               CASE WHEN f.trade_date IS NOT NULL THEN fii_stats_fut_net_pct ELSE vix_close END AS vix_close,
               fii_net_flow_cr
        FROM levels_1 l LEFT JOIN flow_1 f USING (series_id, trade_date)""",
    "gap_patch": f"""
        SELECT series_id, trade_date, {', '.join(f'round({c}, 6) AS {c}' for c in _gap_columns)}
        FROM ({_patched('joined_m', TEST_GAPS)})""",
    "lag5_deltas": f"SELECT series_id, trade_date, {', '.join(DELTAS)} FROM ({_deltas('joined_1')})",
    "vol_spread": """
        SELECT series_id, trade_date,
               round(vix_close - applicable_daily_vol * sqrt(252.0::DOUBLE) * 100, 6) AS vix_realized_spread
        FROM levels_1 LEFT JOIN vol_1 USING (series_id, trade_date)""",
    "daily_features_single": f"{_DAILY} FROM daily_1",
    "daily_features_many_series": f"{_DAILY} FROM daily_m",
    "snapshot_roundtrip": f"{_DAILY} FROM daily_1",
    "snapshot_order": """
        SELECT series_id, trade_date, row_number() OVER (ORDER BY trade_date, series_id) AS place FROM joined_m""",
    "daily_features_refreshed": f"{_DAILY} FROM daily_m",
    "monthly_boundaries": "SELECT * FROM pbounds",
    "model_frame": "SELECT series_id, trade_date, pos, fwd_ret_20d, pcr, basis_chg_5d FROM dframe",
    "asof_position": f"""
        SELECT series_id, expiry, coalesce(p, -1) AS pos, e.trade_date AS embargo_date FROM (
            SELECT *, (SELECT max(pos) FROM pframe f WHERE f.series_id = b.series_id AND f.trade_date <= expiry) AS p
            FROM pbounds b
            WHERE expiry <= (SELECT max(trade_date) FROM pframe f WHERE f.series_id = b.series_id)) q
        LEFT JOIN (SELECT series_id, pos + {_EMBARGO} AS p, trade_date FROM pframe) e USING (series_id, p)""",
    "boundary_pairs": f"""
        SELECT series_id, CAST(row_number() OVER w - 1 AS INTEGER) AS boundary_no, expiry,
               lead(expiry) OVER w AS next_expiry
        FROM pbounds b WHERE expiry <= (SELECT max(trade_date) FROM pframe f WHERE f.series_id = b.series_id)
        WINDOW w AS (PARTITION BY series_id ORDER BY expiry)
        QUALIFY boundary_no >= {_WARMUP} AND next_expiry IS NOT NULL""",
    "walk_forward_folds": "SELECT * FROM pfolds",
    "folds_many_series": _folds(
        "sframe", "sbounds", SHORT_FOLDS.embargo_rows, SHORT_FOLDS.min_train_boundaries, SHORT_FOLDS.min_train_rows,
        SHORT_FOLDS.min_test_rows,
    ),
    "fold_membership": "SELECT * FROM members",
    "fold_sizes": "SELECT series_id, fold_id, role, count(*) AS n_rows FROM members GROUP BY ALL",
    "fold_overlap": """
        SELECT series_id, fold_id, count(s.trade_date) AS n_shared FROM pfolds LEFT JOIN (
            SELECT series_id, fold_id, trade_date FROM members WHERE role = 'train'
            INTERSECT SELECT series_id, fold_id, trade_date FROM members WHERE role = 'test') s
        USING (series_id, fold_id) GROUP BY ALL""",
    "line_predictions": "SELECT * FROM predictions",
    "near_constant": "SELECT * FROM flat",
    "ic_pearson": f"SELECT {_KEYS}, round(ic_pearson, 6) AS ic_pearson, n_test FROM results",
    "ic_spearman": f"SELECT {_KEYS}, round(ic_spearman, 6) AS ic_spearman, n_test FROM results",
    "rmse_diracc": f"SELECT {_KEYS}, round(rmse, 6) AS rmse, round(dir_acc, 6) AS dir_acc, n_test FROM results",
    "fold_summary": "SELECT * EXCLUDE (meets_threshold, run_id) FROM summary",
    "experiment_grid": f"""
        SELECT model_name || '__' || feature_variant AS run_name, model_name, feature_variant, series_id, fold_id,
               strftime(test_start, '%Y-%m-%d') AS test_start
        FROM pfolds, (VALUES ('last_label'), ('moved_label'), ('least_squares')) m(model_name),
             (VALUES {', '.join(f"('{c}')" for c in LINE_INPUTS)}) v(feature_variant)""",
    "rank_experiments": _REPORT,
    "report_csv": _REPORT,
    "report_json": _REPORT,
    "run_log": f"""
        SELECT 'cv__' || model_name || '__' || feature_variant AS run_id, model_name, feature_variant,
               feature_variant AS feature_cols, '6' AS places, 'fwd_ret_20d' AS target, 1::INTEGER AS n_features,
               (SELECT count(DISTINCT train_end) FROM pfolds) AS n_folds_requested,
               CASE WHEN s.model_name IS NULL THEN 'no_valid_folds' ELSE 'ok' END AS status,
               coalesce(meets_threshold, false) AS meets_threshold, coalesce(n_folds, 0) AS n_folds, mean_rmse
        FROM (SELECT * FROM (VALUES ('last_label'), ('moved_label'), ('least_squares'), ('never_fitted')) m(model_name),
             (VALUES {', '.join(f"('{c}')" for c in LINE_INPUTS)}) v(feature_variant)) g
        LEFT JOIN summary s USING (model_name, feature_variant)""",
    "winner": """
        SELECT model_name, feature_variant, mean_ic_pearson, positive_fold_pct, meets_threshold, n_folds FROM best""",
    "production_lookup": """
        SELECT name, version AS production_version, tag_ic AS production_ic FROM production""",
    "promotion_gate": """
        SELECT run_id, mean_ic_pearson, tag_ic AS production_ic, reasons = '' AS passed, reasons FROM (
            SELECT *, concat_ws('; ',
                CASE WHEN n_folds <= 0 THEN 'no completed folds' END,
                CASE WHEN coalesce(mean_ic_pearson < 0.05, true) THEN 'mean_ic_pearson below floor' END,
                CASE WHEN coalesce(positive_fold_pct < 0.55, true) THEN 'positive_fold_pct below floor' END,
                CASE WHEN mean_ic_pearson < tag_ic THEN 'mean_ic_pearson below production' END) AS reasons
            FROM summary LEFT JOIN production ON true)""",
    "registry_publish": f"""
        SELECT name, version, CASE WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage, tag_ic,
               NULL::DOUBLE AS tag_share, NULL::VARCHAR AS source_run_id
        FROM registry
        UNION ALL
        SELECT '{REGISTERED_MODEL_NAME}', CAST((SELECT max(version) + 1 FROM registry) AS INTEGER), 'Production',
               mean_ic_pearson, positive_fold_pct, run_id
        FROM best""",
    "log_returns": "SELECT series_id, trade_date, round(log_ret, 10) AS log_ret FROM rets",
    "garch_path_fixed": f"SELECT series_id, trade_date, {_GARCH8} FROM path",
    "garch_forecast_fixed": f"SELECT series_id, fold_id, trade_date, {_GARCH8} FROM forecast",
    "garch_join": f"""
        SELECT series_id, fold_id, trade_date, role, {_GARCH8} FROM members
        LEFT JOIN (SELECT series_id, trade_date, 'train' AS role, sigma, chg FROM path) USING (series_id, trade_date, role)
        WHERE role = 'train'
        UNION ALL
        SELECT series_id, fold_id, trade_date, role, {_GARCH8} FROM members
        LEFT JOIN forecast USING (series_id, fold_id, trade_date) WHERE role = 'test'""",
    "garch_fill": f"""
        SELECT p.series_id, p.trade_date, close, {_GARCH8} FROM pfeat p
        LEFT JOIN (SELECT * FROM path QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY pos DESC) = 1)
        USING (series_id)""",
    **{f"refit_{name}": _no_difference(name, "baseline_full") for name in ("xgboost", "lightgbm", "catboost")},
    "refit_and_score": _no_difference("random_forest", "baseline_full_garch"),
    "stream_score": _no_difference("random_forest", "baseline_full_garch"),
    "missing_features": f"SELECT series_id, trade_date, concat_ws(',', {_missing}) AS missing FROM daily_1",
    "sample_row": f"""{_DAILY} FROM daily_1 WHERE {_complete}
        ORDER BY md5(series_id || '|' || CAST(trade_date AS VARCHAR) || '|7'), series_id, trade_date LIMIT 1""",
    "garch_fit_checks": f"""
        SELECT series_id, fold_id, n_returns, true AS sound, true AS certified, true AS beats_all,
               {', '.join(f'round(loglik_{n}, 6) AS loglik_{n}' for n in range(1, len(GARCH_RIVALS) + 1))}
        FROM (SELECT series_id, fold_id, rival, count(*) AS n_returns, sum(l) AS l
              FROM pfolds JOIN rivals_loglik USING (series_id) WHERE trade_date <= embargo_date GROUP BY ALL)
        PIVOT (any_value(l) FOR rival IN ({', '.join(f"'loglik_{n}'" for n in range(1, len(GARCH_RIVALS) + 1))})
               GROUP BY series_id, fold_id, n_returns)""",
    "stump_cv": f"""
        SELECT n.model_name, 'month' AS feature_variant, series_id, fold_id, trade_date,
               round(CASE WHEN month(trade_date) <= cut THEN low ELSE high END, 6) AS prediction
        FROM ({_stump(_stump_rows, 'train_end')}) JOIN pfolds USING (train_end)
        JOIN members USING (series_id, fold_id),
             (VALUES ('random_forest'), ('xgboost'), ('lightgbm'), ('catboost')) n(model_name)
        WHERE role = 'test'""",
    "stump_refit_score": _stump_scores,
    "penalised_rounds": f"""
        SELECT series_id, trade_date, round(
            (SELECT avg(fwd_ret_20d) FROM pframe) + 0.5 * CASE WHEN month(trade_date) <= a.cut THEN a.low ELSE a.high END
                + 0.5 * CASE WHEN month(trade_date) <= b.cut THEN b.low ELSE b.high END, 6) AS prediction
        FROM pfeat, ({_first_round}) a, ({_second_round}) b""",
    "stump_stream": _stump_scores,
}

ORACLES = {name: _sql(final) for name, final in FINAL.items()}
