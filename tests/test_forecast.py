"""Folds, naive rules, reconciliation, champion, bands and the per-series models."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lakeplan.config import PlanConfig
from lakeplan.forecast import conformal as cf
from lakeplan.forecast import grid as gr
from lakeplan.forecast import models as md
from lakeplan.forecast import reconcile as rc
from lakeplan.forecast import structural as st
from lakeplan.forecast import table_function as tf
from lakeplan.forecast.accuracy import log_run
from tests import plain_models as plain

CFG = PlanConfig("2024-06-30", "2024-06-24", "2022-01-01", "2024-12-31")


def series(spark, n, expr="CAST(10 + id AS double)", key="S"):
    """``n`` weeks ending at the last full week."""
    return spark.range(n).selectExpr(
        "'sku' AS level", f"'{key}' AS series_key", "'Z' AS zone",
        f"date_add(DATE'2024-06-24', CAST(7 * (id - {n - 1}) AS int)) AS week_start", f"{expr} AS units", "0.1D AS promo_share")


def steps(spark, n, **kw):
    origins = gr.rolling_origins(gr.series_arrays(series(spark, n, **kw), gr.SERIES), CFG)
    return gr.base_forecasts(origins, gr.SERIES)


def test_grid_fills_gaps_from_the_first_sale(spark):
    weekly = spark.sql("""SELECT * FROM VALUES ('S', 'Z', DATE'2024-06-03', 5L, 0.5D), ('S', 'Z', DATE'2024-06-17', 7L, NULL),
        ('S', 'Z', DATE'2024-07-01', 9L, 0.1D) t(sku_id, zone, week_start, units, promo_share)""")
    rows = gr.weekly_grid(weekly, ["sku_id", "zone"], "2024-06-24", 2).orderBy("week_start").collect()
    assert [r.units for r in rows] == [5.0, 0.0, 7.0, 0.0, None, None]
    assert [r.promo_share for r in rows][:4] == [0.5, 0.0, 0.0, 0.0]


def test_folds_of_55_weeks(spark):
    cuts = {r.cutoff for r in steps(spark, 55).where("kind = 'backtest'").select("cutoff").distinct().collect()}
    last = dt.date(2024, 6, 24)
    assert cuts == {last - dt.timedelta(weeks=12), last - dt.timedelta(weeks=24)}
    assert steps(spark, 55).where("kind = 'forecast'").count() == 13


def test_naive_and_recent_mean(spark):
    fc = steps(spark, 60).where("kind = 'forecast'").orderBy("week_start").collect()
    assert fc[0].snaive == 10 + 60 - 52 and fc[12].snaive == 10 + 72 - 52
    young = steps(spark, 30).where("kind = 'forecast'").first()
    assert young.snaive == np.mean([36, 37, 38, 39]) and young.promo_future == 0.0 and not young.is_short
    assert steps(spark, 25).where("kind = 'forecast'").first().is_short
    assert steps(spark, 40, expr="0D").where("kind = 'forecast'").first().is_short
    assert steps(spark, 25).where("kind = 'forecast'").first().recent_mean == np.mean(range(27, 35))


@pytest.mark.parametrize("n, model", [(25, "recent_mean"), (26, "structural"), (120, "structural")])
def test_model_choice_and_shape(spark, n, model):
    grid = series(spark, n).unionByName(spark.range(13).selectExpr(
        "'sku' AS level", "'S' AS series_key", "'Z' AS zone", "date_add(DATE'2024-07-01', CAST(7 * id AS int)) AS week_start",
        "CAST(NULL AS double) AS units", "CAST(NULL AS double) AS promo_share"))
    events = spark.sql("SELECT 'E' AS event_name, DATE'2024-03-01' AS event_date")
    rows = st.fit_series(gr.with_events(grid, events), CFG, 2).where("kind = 'forecast'").collect()
    assert len(rows) == 13 and {r.model for r in rows} == {model} and all(r.yhat >= 0 for r in rows)


def test_structural_model_beats_naive_on_planted_signal():
    rng = np.random.default_rng(1)
    n, cut = 208, 196
    t = np.arange(n)
    events = np.zeros((n, 1))
    events[[40, 93, 145, 198], 0] = 1  # moves against the calendar, so last year's week misses it
    y = (100 + 0.5 * t) * (1 + 0.4 * np.sin(2 * np.pi * t * 7 / 365.25)) * np.where(events[:, 0] > 0, 2.0, 1.0)
    y *= np.exp(rng.normal(0, 0.05, n))
    hat = plain.structural_forecast(y[:cut], np.zeros(cut), events, t, cut, 12, np.zeros(12))
    wape = lambda f: np.abs(y[cut:] - f).sum() / y[cut:].sum()
    assert wape(hat) < 0.15 < wape(plain.seasonal_naive(y, cut, 12))


def test_smoothing_follows_the_season_and_brackets_the_mean():
    t = np.arange(160)
    y = 50 + 20 * np.sin(2 * np.pi * t / 52)
    mean, lo, hi = md.smoothing_forecast(y, 12, 1.28)
    assert np.abs(mean - (50 + 20 * np.sin(2 * np.pi * (160 + np.arange(12)) / 52))).max() < 8
    assert (lo <= mean).all() and (hi >= mean).all()
    short = md.smoothing_forecast(np.array([3.0, 4.0]), 3, 1.28)[0]
    assert np.isfinite(short).all()


def test_share_and_top_down(spark):
    grid = spark.sql("""SELECT * FROM VALUES ('a', 'Z', 'P', DATE'2024-06-24', 3D), ('b', 'Z', 'P', DATE'2024-06-24', 1D),
        ('a', 'Z', 'P', DATE'2024-03-25', 99D), ('c', 'Z', 'Q', DATE'2024-06-24', 0D)
        t(sku_id, zone, base_product, week_start, units)""")
    cut = spark.sql("SELECT DATE'2024-06-24' AS cutoff")
    share = {r.sku_id: r.share for r in rc.trailing_share(cut, grid, "base_product").collect()}
    assert share == {"a": 0.75, "b": 0.25, "c": 0.0}
    child = spark.sql("""SELECT * FROM VALUES ('a', 'P'), ('c', 'Q'), ('d', 'P') t(sku_id, base_product)""").selectExpr(
        "*", "'Z' AS zone", "DATE'2024-06-24' AS cutoff", "DATE'2024-07-01' AS week_start", "8D AS direct")
    parent = spark.sql("SELECT * FROM VALUES ('P', 40D), ('Q', 5D) t(base_product, yhat)").selectExpr(
        "*", "'Z' AS zone", "DATE'2024-06-24' AS cutoff", "DATE'2024-07-01' AS week_start")
    top = {r.sku_id: r.topdown for r in rc.top_down(
        child, parent, rc.trailing_share(cut, grid, "base_product"), "base_product").collect()}
    assert top == {"a": 30.0, "c": 0.0, "d": 8.0}


def test_naive_never_wins(spark):
    wapes = spark.sql("SELECT * FROM VALUES ('seasonal_naive', 0.1D), ('direct', 0.3D), ('combined', 0.3D) t(candidate, wape)")
    assert rc.champion(wapes).first().candidate == "combined"


def test_bands_default_and_coverage_near_eighty(spark):
    bt = spark.range(4000).select(
        F.lit("c").alias("category"), F.lit("Z").alias("zone"), F.lit(100.0).alias("fc"),
        (100 * F.exp(0.3 * F.randn(7))).alias("actual"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS int) * 84)").alias("cutoff"))
    row = cf.holdout_coverage(bt, ["category", "zone"]).first()
    assert 0.76 < row.coverage < 0.84
    other = bt.limit(1).withColumn("category", F.lit("new"))
    band = cf.apply_bands(other, cf.calibrate(bt, ["category", "zone"]), ["category", "zone"], (0.6, 1.4)).first()
    assert (band.lower, band.upper) == (60.0, 140.0)


def test_run_log_appends(spark, tmp_path):
    metrics = spark.sql("SELECT 0.5D AS wape, 10L AS series")
    for name in ("r1", "r2"):
        log_run(spark, f"{tmp_path}/runs", name, {"folds": 3}, metrics)
    rows = spark.read.parquet(f"{tmp_path}/runs").orderBy("run_name").collect()
    assert [r.run_name for r in rows] == ["r1", "r2"] and rows[0].metrics["wape"] == 0.5 and rows[0].params["folds"] == "3"


def uneven_series(spark):
    """Series of many lengths on both levels: short, young, empty, seasonal, with promos and events."""
    rng, rows = np.random.default_rng(4), []
    last = dt.date(2024, 6, 24)
    for i, n in enumerate((1, 5, 20, 25, 26, 33, 45, 59, 60, 71, 90, 104, 150, 151, 200)):
        for level in ("sku", "base"):
            for k in range(n + 13):
                day = last + dt.timedelta(weeks=k - n + 1)
                past = k < n
                units = float(rng.integers(0, 60)) * (i != 6) if past else None
                rows.append((level, f"S{i}", "Z", day, units, float(rng.random() < 0.2) if past else None))
    return spark.createDataFrame(rows, "level string, series_key string, zone string, week_start date, units double, promo_share double")


def test_stacked_model_equals_one_series_at_a_time(spark):
    events = spark.sql("""SELECT * FROM VALUES ('E', DATE'2024-03-01'), ('E', DATE'2023-03-05'), ('F', DATE'2022-11-11'), ('G', DATE'2024-08-01'),
        ('F', DATE'2024-07-10') t(event_name, event_date)""")
    grid = gr.with_events(uneven_series(spark), events, apart=True)
    fit = st.fit_series(grid, CFG, 3)
    assert "FlatMapGroups" not in fit._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r)[:6]: r for r in fit.collect()}
    want = {}
    for _, part in grid.toPandas().groupby(["level", "series_key", "zone"]):
        for r in plain.series_forecaster(CFG)(part).itertuples(index=False):
            want[tuple(r)[:6]] = r
    assert got.keys() == want.keys() and {r.model for r in got.values()} == {"structural", "recent_mean"}
    for key, r in want.items():
        assert got[key].model == r.model and abs(got[key].snaive - r.snaive) < 1e-9
        assert abs(got[key].yhat - r.yhat) <= 1e-9 * max(1.0, abs(r.yhat)), key
        assert got[key].actual == (r.actual if r.actual == r.actual else None)


def test_smoothing_from_sql(spark):
    name = tf.register(spark)
    weekly = uneven_series(spark).where("level = 'sku' AND units IS NOT NULL").select("series_key", "zone", "week_start", "units")
    call = f"SELECT * FROM {name}(TABLE({{t}}) PARTITION BY (series_key, zone) ORDER BY week_start, horizon => 12, width => 0.9)"
    got = {tuple(r) for r in spark.sql(call, t=weekly).collect()}
    assert got == {tuple(r) for r in md.ets_baseline(weekly, 12, 0.9, 2).collect()} and len(got) == 15 * 12
    odd = weekly.where("series_key = 'S5'").unionByName(spark.sql("SELECT 'S5' AS series_key, 'Z' AS zone, CAST(NULL AS date) AS week_start, 3D AS units"))
    assert spark.sql(call, t=odd).count() == 12 and spark.sql(call, t=weekly.limit(0)).count() == 0


@pytest.mark.parametrize("rest, said", [
    ("TABLE({t}) PARTITION BY series_key, horizon => 0, width => 0.9", "horizon = 0 is out of range"),
    ("TABLE({t}) PARTITION BY series_key, horizon => 12, width => 1.5", "width = 1.5 is out of range"),
    ("TABLE({t}) PARTITION BY series_key, horizon => 'x', width => 0.9", "horizon must be a constant number"),
    ("TABLE(SELECT 'a' AS week_start, 1D AS units) PARTITION BY week_start, horizon => 1, width => 0.9", "needs a DATE column"),
    ("TABLE(SELECT DATE'2024-01-01' AS week_start, 'a' AS units) PARTITION BY units, horizon => 1, width => 0.9", "needs a numeric column"),
    ("TABLE({t}) PARTITION BY series_key, horizon => 12", "missing a required argument"),
])
def test_wrong_arguments_fail_in_analysis(spark, rest, said):
    weekly = uneven_series(spark).select("series_key", "week_start", "units")
    with pytest.raises(AnalysisException, match=said):
        spark.sql(f"SELECT * FROM {tf.register(spark)}({rest})", t=weekly)
