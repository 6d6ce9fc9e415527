"""Forecasting (FC) and grouped functions (UDF)."""

from pyspark.sql import functions as F

from lakeplan.forecast import accuracy as ac
from lakeplan.forecast import conformal as cf
from lakeplan.forecast import grid as gr
from lakeplan.forecast import models as md
from lakeplan.forecast import reconcile as rc
from lakeplan.forecast import structural as st
from lakeplan.forecast import table_function as tf
from lakeplan.forecast.run import CHILD_LEVEL, candidate_table, plan_from_candidates, structural_forecasts
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import R, W
from lakeplan.plans.stand_in import CFG
from lakeplan.session import checkpoint_table


def structural_plan(s):
    """The planning tables on the structural model; both stages are read several times."""
    raw = checkpoint_table(structural_forecasts(s.saved_weekly, s.products, s.events, CFG), "forecast_raw")
    cand = checkpoint_table(candidate_table(raw, s.grid, s.products, CFG), "candidates")
    return plan_from_candidates(cand, s.products, CFG)


def shown(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("fc1_weekly_grid", "SELECT sku_id, zone, week_start, units, promo_share FROM s_grid")
def fc1(s):
    return s.grid.select("sku_id", "zone", "week_start", "units", "promo_share")


@query("fc2_parent_series", f"""SELECT series_key, zone, week_start, units, {R('promo_share', 6)} AS promo_share FROM s_both
    WHERE level = 'base'""")
def fc2(s):
    return shown(s.both_levels.where("level = 'base'").select("series_key", "zone", "week_start", "units", "promo_share"),
                 promo_share=6)


@query("fc3_event_weeks", """SELECT w.week_start, w.zone, CAST(sum(w.units) AS BIGINT) AS units, min(e.names) AS events FROM s_weekly w
    LEFT JOIN (SELECT week_start, string_agg(event_name, ',' ORDER BY event_name) AS names FROM (
    SELECT DISTINCT event_name, CAST(date_trunc('week', event_date) AS DATE) - k AS week_start FROM s_events, (VALUES (0), (7)) v(k))
    GROUP BY week_start) e ON e.week_start = w.week_start GROUP BY w.week_start, w.zone""")
def fc3(s):
    per_week = s.weekly.groupBy("week_start", "zone").agg(F.sum("units").alias("units"))
    named = gr.with_events(per_week, s.events)
    names = F.when(F.size("events") > 0, F.array_join("events", ","))
    return named.select("week_start", "zone", "units", names.alias("events"))


@query("fc4_rolling_folds", """SELECT t.level, t.series_key, t.zone, t.cutoff, t.week_start, t.actual FROM s_raw_fc t
    WHERE kind = 'backtest'""")
def fc4(s):
    keys = gr.SERIES
    origins = gr.rolling_origins(gr.series_arrays(s.both_levels, keys), CFG, with_future=False)
    return gr.base_forecasts(origins, keys).select(*keys, "cutoff", "week_start", "actual")


@query("fc5_seasonal_naive", "SELECT level, series_key, zone, kind, cutoff, week_start, snaive FROM s_raw_fc")
def fc5(s):
    return s.raw_forecasts.select(*gr.SERIES, "kind", "cutoff", "week_start", "snaive")


@query("fc6_recent_mean", "SELECT level, series_key, zone, kind, cutoff, week_start, recent_mean, is_short FROM s_raw_fc")
def fc6(s):
    return s.raw_forecasts.select(*gr.SERIES, "kind", "cutoff", "week_start", "recent_mean", "is_short")


FIT_SQL = """SELECT level, series_key, zone, kind, cutoff, week_start, actual, {0} AS snaive, CASE WHEN is_short THEN 'recent_mean'
    ELSE 'structural' END AS model, CASE WHEN is_short THEN {1} END AS short_forecast, true AS bounded FROM s_raw_fc""".format(
    R("snaive", 6), R("recent_mean", 6))


def fit_checks(fit):
    """What SQL can say of the per-series models: all keys and labels, the naive and short-series values, and bounds."""
    short = F.when(F.col("model") == "recent_mean", F.round("yhat", 6))
    return fit.select(*gr.SERIES, "kind", "cutoff", "week_start", "actual", F.round("snaive", 6).alias("snaive"), "model",
                      short.alias("short_forecast"), F.coalesce(F.col("yhat") >= 0, F.lit(False)).alias("bounded"))


@query("fc7_structural_fit", FIT_SQL)
def fc7(s):
    """The per-series model on both levels."""
    return fit_checks(structural_forecasts(s.saved_weekly, s.products, s.events, CFG))


@query("fc7_structural_leaderboard", """SELECT level, candidate, true AS measured FROM (VALUES ('sku x zone x week'),
    ('base product x zone x week')) l(level), (VALUES ('direct'), ('topdown'), ('combined'), ('direct+snaive'), ('topdown+snaive'),
    ('combined+snaive'), ('seasonal_naive')) n(candidate)""")
def fc7_board(s):
    """Every candidate's WAPE on the structural model; the values have no SQL twin, but each must be there."""
    board = structural_plan(s).comparison
    return board.select("level", "candidate", F.coalesce(F.col("wape") >= 0, F.lit(False)).alias("measured"))


@query("fc7_structural_values")
def fc7_values(s):
    """Every forecast and backtest of the per-series model."""
    return shown(structural_forecasts(s.saved_weekly, s.products, s.events, CFG), yhat=6, snaive=6)


@query("fc7_structural_wape")
def fc7_wape(s):
    """The board itself: every candidate's WAPE, and which one leads."""
    return shown(structural_plan(s).comparison, wape=6)


@query("udf2_one_pass_two_outputs", """SELECT kind, level, count(*) AS rows, count(actual) AS actuals, count(DISTINCT (series_key, zone))
    AS series FROM s_raw_fc GROUP BY ALL""")
def udf2(s):
    """Backtests and forecast come tagged from one pass over the series and are split afterwards."""
    fit = checkpoint_table(structural_forecasts(s.saved_weekly, s.products, s.events, CFG), "tagged_fit")
    sides = [fit.where(F.col("kind") == k) for k in ("backtest", "forecast")]
    return sides[0].unionByName(sides[1]).groupBy("kind", "level").agg(
        F.count(F.lit(1)).alias("rows"), F.count("actual").alias("actuals"), F.countDistinct("series_key", "zone").alias("series"))


@query("udf1_grouped_map", FIT_SQL + " WHERE level = 'sku'")
def udf1(s):
    """A Python function over the child series only, each one row of arrays: one stacked solve for all series of a batch."""
    grid = gr.weekly_grid(s.saved_weekly, ["sku_id", "zone"], CFG.last_full_week, CFG.horizon_weeks + 1)
    child = grid.select(F.lit("sku").alias("level"), F.col("sku_id").alias("series_key"), "zone", "week_start", "units",
                        "promo_share")
    return fit_checks(st.fit_series(gr.with_events(child, s.events, apart=True), CFG))


@query("fc8_future_promo", "SELECT level, series_key, zone, kind, cutoff, week_start, "
       f"{R('promo_future', 6)} AS promo_future FROM s_raw_fc")
def fc8(s):
    return shown(s.raw_forecasts.select(*gr.SERIES, "kind", "cutoff", "week_start", "promo_future"), promo_future=6)


@query("fc9_trailing_share", "SELECT cutoff, sku_id, zone, base_product, share FROM s_share")
def fc9(s):
    cutoffs = s.raw_forecasts.where("level = 'sku'").select("cutoff").distinct()
    return rc.trailing_share(cutoffs, s.grid, "base_product", CFG.share_weeks).select(
        "cutoff", "sku_id", "zone", "base_product", "share")


CAND = ["sku_id", "zone", "kind", "cutoff", "week_start"]


@query("fc10_top_down", f"SELECT {', '.join(CAND)}, {R('topdown', 6)} AS topdown FROM s_cand")
def fc10(s):
    return shown(s.candidates.select(*CAND, "topdown"), topdown=6)


BLENDS = [rc.column_of(n) for n in rc.candidates()]


@query("fc11_candidate_blends", f"SELECT {', '.join(CAND)}, {', '.join(f'{R(c, 6)} AS {c}' for c in BLENDS)} FROM s_blend")
def fc11(s):
    return shown(s.candidates.select(*CAND, *BLENDS), **{c: 6 for c in BLENDS})


@query("fc12_candidate_wape", f"SELECT level, candidate, {R('wape', 6)} AS wape, is_champion FROM s_board")
def fc12(s):
    return shown(s.plan.comparison, wape=6)


@query("fc13_champion", f"SELECT candidate, {R('wape', 6)} AS wape FROM s_wape_child JOIN s_champion USING (candidate)")
def fc13(s):
    bt = s.candidates.where("kind = 'backtest'")
    return shown(rc.champion(rc.wape_by_candidate(bt, CHILD_LEVEL)).select("candidate", "wape"), wape=6)


@query("fc14_conformal_bands", f"SELECT category, zone, {R('q_lo', 6)} AS q_lo, {R('q_hi', 6)} AS q_hi FROM s_bands")
def fc14(s):
    bt = s.candidates.where("kind = 'backtest'")
    winner = rc.champion(rc.wape_by_candidate(bt, CHILD_LEVEL)).select("candidate").scalar()
    bands = cf.calibrate(bt.withColumn("fc", rc.chosen(winner)), ["category", "zone"])
    return shown(bands, q_lo=6, q_hi=6)


@query("fc15_holdout_coverage", f"""SELECT {R('avg(CASE WHEN actual BETWEEN fc * q_lo AND fc * q_hi THEN 1 ELSE 0 END)', 6)} AS coverage,
    count(*) AS points FROM s_hold h JOIN s_cal USING (category, zone) WHERE cutoff = (SELECT max(cutoff) FROM s_hold)""", {
    "s_hold": "SELECT * FROM s_scored WHERE kind = 'backtest' AND fc > 0.5",
    "s_cal": """SELECT category, zone, quantile_disc(actual / fc, 0.1) AS q_lo, quantile_disc(actual / fc, 0.9) AS q_hi FROM s_hold
        WHERE cutoff < (SELECT max(cutoff) FROM s_hold) GROUP BY ALL"""})
def fc15(s):
    bt = s.candidates.where("kind = 'backtest'")
    winner = rc.champion(rc.wape_by_candidate(bt, CHILD_LEVEL)).select("candidate").scalar()
    return shown(cf.holdout_coverage(bt.withColumn("fc", rc.chosen(winner)), ["category", "zone"]), coverage=6)


@query("fc16_series_accuracy", "SELECT * FROM s_accuracy")
def fc16(s):
    return s.plan.accuracy


@query("fc17_run_summary", f"""SELECT {R('avg(CASE WHEN a.wape_model < a.wape_seasonal_naive THEN 1 ELSE 0 END)', 6)} AS share_beating_naive,
    {R(R('sum(b.fc - b.act)', 6) + ' / sum(b.act)', 6)} AS bias, count(*) AS series FROM s_accuracy a JOIN (SELECT sku_id, zone,
    sum(forecast_units) AS fc, sum(actual) AS act FROM s_backtest GROUP BY ALL) b USING (sku_id, zone) WHERE a.actual_units > 0""")
def fc17(s):
    return shown(ac.run_summary(s.plan.accuracy, s.plan.backtest), share_beating_naive=6, bias=6)


def smoothed(s):
    grid = s.grid.withColumnRenamed("sku_id", "series_key")
    return md.ets_baseline(grid, CFG.horizon_weeks + 1)


def baseline_sql(level, weeks):
    return f"""SELECT series_key, zone, CAST(last_week + 7 * i AS DATE) AS week_start, true AS bounded FROM (SELECT series_key, zone,
        max(week_start) AS last_week FROM s_both WHERE level = '{level}' GROUP BY ALL), (SELECT CAST(unnest(generate_series(1, {weeks}))
        AS INTEGER) AS i)"""


def baseline_checks(df):
    """All keys and weeks, and ordered bounds at or above zero."""
    ordered = F.expr("forecast_lower >= 0 AND forecast_lower <= forecast_units AND forecast_units <= forecast_upper")
    return df.select("series_key", "zone", "week_start", F.coalesce(ordered, F.lit(False)).alias("bounded"))


@query("fc18_smoothing_baseline", baseline_sql("sku", CFG.horizon_weeks + 1))
def fc18(s):
    return baseline_checks(smoothed(s))


@query("fc18_smoothing_values")
def fc18_values(s):
    """The second baseline itself, with its interval."""
    return smoothed(s)


def called_from_sql(s, width):
    """The baseline of the parent series, asked for in SQL."""
    name = tf.register(s.spark)
    parent = s.both_levels.where("level = 'base'").select("series_key", "zone", "week_start", "units")
    return s.spark.sql(f"""SELECT * FROM {name}(TABLE({{parent}}) PARTITION BY (series_key, zone) ORDER BY week_start,
        horizon => {CFG.horizon_weeks}, width => {width})""", parent=parent)


@query("udf4_table_function", baseline_sql("base", CFG.horizon_weeks))
def udf4(s):
    """The baseline as a table-valued function of a table, a horizon and an interval width."""
    return baseline_checks(called_from_sql(s, 0.9))


@query("udf4_table_function_values")
def udf4_values(s):
    return called_from_sql(s, 0.9)


@query("fc19_model_comparison", f"""SELECT f.week_start, f.zone, {R('sum(f.forecast_units)', 1)} AS champion_units,
    {R('sum(f.direct_units)', 1)} AS direct_units, {R('sum(f.seasonal_naive_units)', 1)} AS seasonal_naive_units,
    {R('sum(b.forecast_units)', 1)} AS baseline_units FROM s_forecast f LEFT JOIN s_baseline b
    ON b.sku_id = f.sku_id AND b.zone = f.zone AND b.week_start = f.week_start GROUP BY ALL""")
def fc19(s):
    return ac.compare_models(s.plan.forecast, s.baseline, ["week_start", "zone"])


@query("fc20_run_metrics", f"""SELECT {R(W('forecast_units'), 6)} AS wape_champion,
    {R(W('seasonal_naive_units'), 6)} AS wape_naive, count(*) AS points FROM s_backtest""")
def fc20(s):
    bt = s.plan.backtest
    return shown(bt.agg(ac.wape("actual", "forecast_units").alias("wape_champion"),
                        ac.wape("actual", "seasonal_naive_units").alias("wape_naive"), F.count(F.lit(1)).alias("points")),
                 wape_champion=6, wape_naive=6)


@query("demand_forecast", "SELECT * FROM s_forecast")
def demand_forecast(s):
    return s.plan.forecast


@query("forecast_backtest", "SELECT * FROM s_backtest")
def forecast_backtest(s):
    return s.plan.backtest


@query("forecast_structural_values")
def structural_values(s):
    """The published forecast of a planning run: units, band, and the candidates beside them."""
    return structural_plan(s).forecast


@query("forecast_structural_champion", """SELECT sku_id, zone, week_start, trained_through_week, seasonal_naive_units, true AS bounded
    FROM s_forecast""")
def structural_champion(s):
    """The published forecast on the structural model, the way a planning run makes it."""
    ordered = F.expr("forecast_lower >= 0 AND forecast_lower <= forecast_upper AND forecast_units >= 0 AND model <> 'seasonal_naive'")
    return structural_plan(s).forecast.select("sku_id", "zone", "week_start", "trained_through_week", "seasonal_naive_units",
                                              F.coalesce(ordered, F.lit(False)).alias("bounded"))
