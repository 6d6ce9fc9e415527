"""Calendar, joins, windows, lift and reorder on hand-computed rows."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeplan.config import PlanConfig
from lakeplan.functions.calendar import date_spine, dim_date
from lakeplan.operators import demand as dm
from lakeplan.operators import distinct as dd
from lakeplan.operators import joins as jn
from lakeplan.operators import quality as ql
from lakeplan.operators import reorder as ro
from lakeplan.operators import windows as wn
from lakeplan.operators.facts import fact_sales_line
from lakeplan.operators.filters import Range, apply_filters
from lakeplan.operators.inventory import inventory_daily, ledger, policy_levels
from lakeplan.operators.lift import event_uplift, promotion_lift
from lakeplan.operators.metrics import Field, MetricView, ViewJoin
from lakeplan.session import broadcast_if_small, checkpoint_table, shared_dir, stages

D = dt.date


def test_calendar_traps(spark):
    events = spark.sql("SELECT * FROM VALUES ('B', DATE'2024-03-31'), ('A', DATE'2024-03-31') t(event_name, event_date)")
    rows = {r.date: r for r in dim_date(date_spine(spark, "2024-01-01", "2024-12-31"), events).collect()}
    assert len(rows) == 366
    assert (rows[D(2024, 3, 31)].fiscal_year, rows[D(2024, 3, 31)].fiscal_quarter) == ("FY23-24", "Q4")
    assert (rows[D(2024, 4, 1)].fiscal_year, rows[D(2024, 4, 1)].fiscal_quarter) == ("FY24-25", "Q1")
    wedding = [rows[D(2024, *md)].is_wedding_season for md in ((2, 28), (2, 29), (11, 15))]
    assert wedding == [True, False, True]
    assert rows[D(2024, 3, 31)].week_start == D(2024, 3, 25)  # a Sunday
    assert rows[D(2024, 4, 1)].week_start == D(2024, 4, 1)
    assert rows[D(2024, 3, 31)].event_name == "A / B"


@pytest.mark.parametrize("n", [1, 3, 5, 7, 1000])
def test_global_ntile_equals_ntile(spark, n):
    df = spark.range(n).select("id", (F.col("id") * 7919 % 13).alias("v")).repartition(6)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r.id: r.t for r in wn.global_ntile(df, 5, [-F.col("v"), F.col("id")], "t").collect()}
    want = {r.id: r.t for r in df.select("id", F.ntile(5).over(Window.orderBy(*order)).alias("t")).collect()}
    assert got == want


def test_dense_index_of_a_hot_group(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("z")).repartition(7)
    rows = wn.dense_index(df, ["z"], [F.col("id")]).collect()
    assert all(r.idx == (r.id if r.z == "hot" else r.id - 1500) for r in rows) and len(rows) == 2000


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), (None, 3, 4.0), (None, 4, 4.0)], "z string, i int, v double")
    shares = wn.share_of(df, "v", ["z"])
    assert {r.i: r.share for r in shares.collect()} == {1: 0.25, 2: 0.75, 3: 0.5, 4: 0.5}
    assert "BroadcastHashJoin" in shares._jdf.queryExecution().executedPlan().toString()
    assert {r.i: r.idx for r in wn.dense_index(df, ["z"], [F.col("i")]).collect()} == {1: 0, 2: 1, 3: 0, 4: 1}


def test_exploded_frames_are_not_hinted(spark):
    small = spark.range(10)
    assert "ResolvedHint" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString()
    exploded = small.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(400_000))))
    assert "ResolvedHint" not in broadcast_if_small(exploded)._jdf.queryExecution().analyzed().toString()


def test_shared_folder_is_demanded_off_local_masters(spark, monkeypatch):
    class Other:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared_dir(Other)


def test_stages_are_removed_at_the_end(spark):
    with stages(spark):
        table = checkpoint_table(spark.range(3), "gone")
        path = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_range_filters(spark):
    df = spark.range(10).withColumn("day", F.expr("date_add(DATE'2024-01-01', CAST(id AS int))"))
    pick = lambda **w: [r.id for r in apply_filters(df, w).orderBy("id").collect()]
    assert pick(day=Range(D(2024, 1, 3), D(2024, 1, 5))) == [2, 3, 4]
    assert pick(id=Range(low=8)) == [8, 9] and pick(id=Range(high=0)) == [0] and len(pick(id=Range())) == 10
    view = MetricView(df, [Field("day", "source.day")], [Field("n", "count(1)")])
    assert view.query([], ["n"], {"day": Range(high=D(2024, 1, 4))}).first().n == 4


def test_view_filter_may_use_a_join(spark):
    facts, dim = spark.sql("SELECT id % 3 AS k FROM range(9)"), spark.sql("SELECT * FROM VALUES (0, 'a'), (1, 'b'), (2, 'a') t(k, g)")
    view = MetricView(facts, [], [Field("n", "count(1)")], {"dim": ViewJoin(dim, "source.k = dim.k")}, where="dim.g = 'a'")
    assert view.query([], ["n"]).first().n == 6


def test_buckets_belong_to_the_interval_of_their_point(spark):
    shares = spark.createDataFrame([("z", "a", 0.5), ("z", "b", 0.25), ("z", "c", 0.25)], "zone string, p string, s double")
    rows = dm.bucket_table(shares, ["zone"], "p", "s", 6).orderBy("bucket").collect()
    assert [(r.bucket, r.p) for r in rows] == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "c")]


def test_event_uplift_uses_fixed_divisors_and_promotion_uses_present_days(spark):
    daily = spark.sql("""SELECT * FROM VALUES
        (DATE'2024-03-10', 'C', 'Z', 100.0D, 1.0D), (DATE'2024-03-05', 'C', 'Z', 50.0D, 2.0D),
        (DATE'2024-01-20', 'C', 'Z', 30.0D, 0.0D), (DATE'2024-03-01', 'C', 'Z', 40.0D, 0.0D)
        t(order_date, channel_code, zone, net_revenue, discount_amount)""")
    events = spark.sql("SELECT 'E' AS event_name, DATE'2024-03-10' AS event_date, 2024 AS year, 'All' AS region_relevance")
    row = event_uplift(events, daily, ["zone"]).first()
    assert (row.event_daily_revenue, row.baseline_daily_revenue, row.uplift_pct) == (19.0, 1.0, 1800.0)
    promos = spark.sql("""SELECT 'P' AS promo_id, 'PC' AS promo_code, 'n' AS promo_name, 't' AS promo_type, 'C' AS channel_code,
        'All' AS category_scope, CAST(NULL AS string) AS event_name, 0.1D AS discount_pct, DATE'2024-03-04' AS start_date,
        DATE'2024-03-12' AS end_date""")
    p = promotion_lift(promos, daily).first()
    assert (p.promo_daily_revenue, p.baseline_daily_revenue, p.discount_cost, p.revenue_lift_pct) == (75.0, 40.0, 3.0, 87.5)


def star(spark):
    q = spark.sql
    lines = q("""SELECT * FROM VALUES ('L1', 'O1', 1, DATE'2024-01-05', 'S1', 2, 60.0D, 52.5D, CAST(NULL AS string), 0.5D, 52.5D),
        ('L2', 'O1', 2, DATE'2024-02-05', 'S1', 1, 60.0D, 21.0D, 'X', 0.0D, 21.0D),
        ('L3', 'O9', 1, DATE'2024-01-05', 'S1', 1, 60.0D, 21.0D, 'X', 0.0D, 21.0D)
        t(line_id, order_id, line_no, order_date, sku_id, quantity, unit_mrp, unit_price, promo_code, discount_pct, line_amount)""")
    orders = q("SELECT 'O1' AS order_id, TIMESTAMP'2024-01-05 10:00:00' AS order_ts, 'T1' AS store_id, 'C' AS channel_code, 'K' AS customer_id, 'Delivered' AS order_status, 'Cash' AS payment_mode")
    products = q("SELECT 'S1' AS sku_id, 'cat' AS category, 'bp' AS base_product, 'b' AS base_code, 100 AS pack_size, 0.05D AS tax_rate")
    stores = q("SELECT 'T1' AS store_id, 'W1' AS warehouse_id, 'Z' AS zone, 'ST' AS state, 'CI' AS city")
    costs = q("SELECT 'S1' AS sku_id, DATE'2024-01-01' AS month, 10.0D AS unit_cost")
    returns = q("SELECT * FROM VALUES ('R1', 'L1'), ('R2', 'L1') t(return_id, line_id)")
    return lines, orders, products, stores, costs, returns


def test_fact_line_money_returns_and_missing_cost(spark):
    rows = {r.line_id: r for r in fact_sales_line(*star(spark)).collect()}
    assert set(rows) == {"L1", "L2"}  # the order of L3 has no accepted header
    a = rows["L1"]
    assert (a.net_revenue, a.tax_amount, a.discount_amount, a.cogs, a.gross_margin) == (50.0, 2.5, 50.0, 20.0, 30.0)
    assert (a.volume_kg, a.is_returned, a.date_key) == (0.2, True, 20240105)
    assert rows["L2"].gross_margin is None and rows["L2"].is_returned is False


def test_cover_uses_28_rows_and_ledger_closes(spark):
    moves = spark.range(30).selectExpr(
        "'W' AS warehouse_id", "'S' AS sku_id", "date_add(DATE'2024-01-01', CAST(id AS int)) AS snapshot_date",
        "10L AS receipts_units", "CASE WHEN id < 2 THEN 1000L ELSE 5L END AS demand_units", "5L AS shipped_units")
    led = ledger(moves, 100).orderBy("snapshot_date").collect()
    assert led[0].opening_units == 100 and led[-1].closing_units == 100 + 30 * 5
    assert all(b.opening_units == a.closing_units for a, b in zip(led, led[1:]))
    snaps = ledger(moves, 100).withColumn("safety_stock_units", F.lit(106))
    costs = spark.sql("SELECT 'S' AS sku_id, DATE'2024-01-01' AS month, 2.0D AS unit_cost")
    inv = inventory_daily(snaps, costs).orderBy("snapshot_date").collect()
    assert inv[29].days_of_cover == 50.0  # 250 / 5: the two large days have left the frame
    assert inv[0].is_stockout and inv[0].below_safety_stock and not inv[1].below_safety_stock
    zero = inventory_daily(snaps.withColumn("demand_units", F.lit(0)), costs).first()
    assert zero.days_of_cover is None
    assert policy_levels(moves, 7).orderBy("snapshot_date").first().safety_stock is None


def test_joins(spark):
    stores = spark.sql("SELECT 'A' AS id, DATE'2024-01-01' AS o, DATE'2024-01-03' AS c UNION ALL SELECT 'B', DATE'2024-01-02', NULL")
    days = sorted((r.id, r.date.day) for r in jn.active_days(stores, "o", "c", "2024-01-04", "2024-01-01").collect())
    assert days == [("A", 1), ("A", 2), ("B", 2), ("B", 3), ("B", 4)]
    hist = spark.sql("SELECT * FROM VALUES ('S', DATE'2024-01-01', DATE'2024-02-01', 1.0), ('S', DATE'2024-02-01', NULL, 2.0) t(sku_id, valid_from, valid_to, p)")
    at = spark.sql("SELECT * FROM VALUES ('S', DATE'2023-12-31'), ('S', DATE'2024-01-31'), ('S', DATE'2024-02-01') t(sku_id, d)")
    prices = [None if r.p is None else float(r.p) for r in jn.asof_price(at, hist, "sku_id", "d").orderBy("d").collect()]
    assert prices == [None, 1.0, 2.0]
    pts = spark.sql("SELECT * FROM VALUES ('N', 10.0D, 10.0D), ('S', 50.0D, 50.0D) t(zone, lat, lon)")
    got = {r.zone: r.site for r in jn.nearest(pts, [("a", 11.0, 10.0), ("b", 40.0, 40.0)], override={"S": "a"}).collect()}
    assert got == {"N": "a", "S": "a"}


def test_asof_finds_one_version_a_row(spark):
    """1,000 versions of a key: the join gives as many rows as came in."""
    rng = random.Random(1)
    first = D(2000, 1, 1)
    starts = sorted(rng.sample(range(8000), 1000))
    versions = [("S", first + dt.timedelta(days=a), first + dt.timedelta(days=b) if rng.random() < 0.9 else first + dt.timedelta(days=a + 1), float(i))
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], 9000], strict=True))]
    versions[-1] = (*versions[-1][:2], None, versions[-1][3])
    versions += [("O", None, D(2001, 1, 1), 1.0), ("O", D(2001, 1, 1), None, 2.0), ("O", None, None, 0.5), (None, first, None, 9.0)]
    hist = spark.createDataFrame(versions, "sku_id string, valid_from date, valid_to date, p double")
    days = [(i, "S", first + dt.timedelta(days=rng.randrange(-50, 9500))) for i in range(600)]
    days += [(1000, "O", D(1990, 1, 1)), (1001, "O", D(2001, 1, 1)), (1002, "O", None), (1003, None, first), (1004, "missing", first)]
    at = spark.createDataFrame(days, "i int, sku_id string, d date")
    out = jn.asof_price(at, hist, "sku_id", "d")

    def plain(key, day):
        if key != "S" or day is None:
            return None
        begun = [v for v in versions[:1000] if v[1] <= day]
        return begun[-1][3] if begun and (begun[-1][2] is None or day < begun[-1][2]) else None

    want = {i: plain(k, d) for i, k, d in days} | {1000: 0.5, 1001: 2.0}
    assert {r.i: r.p for r in out.collect()} == want
    assert out.columns == ["i", "sku_id", "d", "valid_from", "valid_to", "p"]
    for broadcast in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            run = jn.asof_price(at, hist, "sku_id", "d")
            run.collect()
            assert join_rows(run) == len(days)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def join_rows(df):
    """Rows out of the joins of an executed plan."""
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        node = plans.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(node.executedPlan())
            continue
        if kind.endswith("JoinExec"):
            total += node.metrics().apply("numOutputRows").value()
        if kind.endswith("QueryStageExec"):
            plans.append(node.plan())
        children = node.children()
        plans += [children.apply(i) for i in range(children.size())]
    return total


def test_windows_of_any_length(spark):
    """From a day to ten years; a window takes at most two pieces a level."""
    rng = random.Random(2)
    spans = [(i, "ab"[i % 2], D(1960, 1, 1) + dt.timedelta(days=rng.randrange(9000)), n) for i, n in enumerate([1, 2, 3, 7, 28, 60, 61, 365, 366, 1000, 3652, 3653] * 3)]
    rows = [(i, k, a, a + dt.timedelta(days=n - 1)) for i, k, a, n in spans] + [(90, "a", D(1970, 1, 5), D(1970, 1, 1)), (91, "a", None, D(1970, 1, 1)), (92, "a", D(1970, 1, 1), None)]
    events = spark.createDataFrame(rows, "e int, k string, a date, b date")
    days = [("ab"[i % 2], D(1959, 12, 1) + dt.timedelta(days=7 * i // 2)) for i in range(4000)]
    daily = spark.createDataFrame([(k, d) for k, d in days], "k string, day date")
    got = sorted((r.e, r.day) for r in jn.event_window_join(events, daily, "a", "b", 5, ["k"], "day").select("e", "day").collect())
    want = sorted((e, d) for e, k, a, b in rows if a and b for key, d in days if key == k and a - dt.timedelta(days=5) <= d <= b)
    assert got == want
    pieces = events.where("a <= b").select("e", F.datediff("b", "a").alias("n"), F.size(jn.dyadic_pieces(F.col("a"), F.col("b"))).alias("pieces")).collect()
    assert all(r.pieces <= 2 * (r.n + 1).bit_length() for r in pieces) and max(r.pieces for r in pieces) <= 22
    assert jn.event_window_join(events.limit(0), daily, "a", "b", 5, ["k"], "day").count() == 0
    pure = jn.event_window_join(events.select("e", "a", "b"), daily.select("day"), "a", "b", 0, [], "day")
    assert pure.count() == sum(a <= d <= b for _, _, a, b in rows if a and b for _, d in days)


def test_bucket_allocation_follows_shares(spark):
    shares = spark.sql("SELECT * FROM VALUES ('Z', 'a', 0.7D), ('Z', 'b', 0.2D), ('Z', 'c', 0.1D) t(zone, item, share)")
    rows = spark.range(20000).select("id", F.lit("Z").alias("zone"))
    out = dm.bucket_allocate(rows, shares, ["zone"], "item", "share", ["id"], buckets=1000)
    got = {r.item: r["count"] / 20000 for r in out.groupBy("item").count().collect()}
    assert all(abs(got[k] - v) < 0.02 for k, v in {"a": 0.7, "b": 0.2, "c": 0.1}.items())
    again = dm.bucket_allocate(rows.repartition(5), shares, ["zone"], "item", "share", ["id"], buckets=1000)
    assert out.join(again.withColumnRenamed("item", "item2"), "id").where("item <> item2").count() == 0


def test_price_versions_do_not_overlap(spark):
    base = spark.sql("SELECT 'S' AS sku_id, 'b' AS base_code, 100.0D AS mrp UNION ALL SELECT 'T', 'x', 10.0D")
    out = dm.apply_revisions(base, [("2024-06-01", ["b"], 0.1), ("2024-01-01", None, 0.5)], "2023-04-01")
    s = sorted((r.valid_from, r.valid_to, r.mrp) for r in out.where("sku_id = 'S'").collect())
    assert s == [(D(2023, 4, 1), D(2024, 1, 1), 100.0), (D(2024, 1, 1), D(2024, 6, 1), 150.0)] + [s[2]]
    assert s[2][1] is None and s[2][2] == 165.0
    assert out.where("sku_id = 'T'").count() == 2


CFG = PlanConfig("2024-06-30", "2024-06-17", "2024-01-01", "2024-12-31")


def recommend(spark, fc, on_hand=None, lead=None, sd=None):
    q = spark.sql
    horizon = q(f"SELECT 'W' AS warehouse_id, 'S' AS sku_id, 4.0D * {fc} AS fc_next_4w, 12.0D * {fc} AS fc_next_12w, {fc}D AS fc_avg_week, 1 AS weekly")
    none = lambda cols: q(f"SELECT 'W' AS warehouse_id, 'S' AS sku_id, {cols}").where("false")
    stock = q(f"SELECT 'W' AS warehouse_id, 'S' AS sku_id, {on_hand}L AS on_hand_units") if on_hand is not None else none("1L AS on_hand_units")
    leads = q(f"SELECT 'W' AS warehouse_id, 'S' AS sku_id, {lead}D AS lead_time_weeks") if lead else none("1D AS lead_time_weeks")
    var = q(f"SELECT 'W' AS warehouse_id, 'S' AS sku_id, {sd if sd else 'CAST(NULL AS double)'} AS sd_week")
    products = q("SELECT 'S' AS sku_id, 'p' AS product_name, 'b' AS base_product, 'c' AS category, 100D AS mrp, 0.05D AS tax_rate")
    wh = q("SELECT 'W' AS warehouse_id, 'DC' AS warehouse_name")
    return ro.reorder(horizon, stock, none("1L AS open_po_units, DATE'2024-01-01' AS next_po_eta"), var, leads, products, wh, CFG).first()


def test_reorder_edges(spark):
    r = recommend(spark, 0)
    assert (r.weeks_of_cover, r.stockout_risk, r.on_hand_units, r.lead_time_weeks, r.safety_stock_units) == (None, "Low", 0, 2.0, 0.0)
    r = recommend(spark, 10, on_hand=15, lead=4, sd="5D")
    assert (r.weeks_of_cover, r.stockout_risk) == (1.5, "High")
    assert r.recommended_order_units == round(10 * 8 + 1.65 * 5 * 2 - 15)
    assert r.projected_stockout_date == D(2024, 7, 10)
    assert recommend(spark, 10, on_hand=30).stockout_risk == "Medium"
    assert recommend(spark, 10, on_hand=50).stockout_risk == "Low"


def test_gate_raises_only_on_a_breach(spark):
    ok = spark.sql("SELECT 'reject_rate' AS check_name, 0.005D AS value, 0.01D AS limit_value, false AS breached")
    assert ql.enforce(ok).first().verdict == "ok"
    bad = ok.withColumn("breached", F.lit(True))
    with pytest.raises(Exception, match="quality gate: reject_rate"):
        ql.enforce(bad).collect()


def test_metric_view_joins_only_what_is_asked(spark):
    src = spark.sql("SELECT * FROM VALUES ('a', 1, 10.0D), ('b', 2, 0.0D) t(zone, k, rev)")
    dim = spark.sql("SELECT 1 AS k, 'one' AS label")
    view = MetricView(src, [Field("zone", "source.zone", synonyms=("region",)), Field("label", "d.label")],
                      [Field("revenue", "sum(source.rev)", synonyms=("sales",))], {"d": ViewJoin(dim, "source.k = d.k")})
    plain = view.query(["region"], ["sales"])
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert {r.label: r.revenue for r in view.query(["label"], ["revenue"]).collect()} == {"one": 10.0, None: 0.0}
    with pytest.raises(KeyError):
        view.query(["nope"], ["revenue"])
    with pytest.raises(ValueError):
        MetricView(src, [Field("x", "1")], [Field("X", "2")])


def test_distinct_members_merge_over_any_keys(spark):
    """More members than one bitmap holds; the second day's members come later and keep the first day's numbers."""
    days = spark.range(120_000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 3 AS int)) AS d", "CAST(id % 7 AS int) AS z",
                                           "CASE WHEN id % 11 <> 0 THEN concat('c', pmod(hash(id), 50000)) END AS c")
    first, later = days.where("d < DATE'2024-01-03'"), days.where("d >= DATE'2024-01-03'")
    ids = checkpoint_table(dd.dense_ids(first, "c"))
    more = checkpoint_table(dd.more_ids(ids, later, "c"))
    numbers = more.agg(F.min("member_no"), F.max("member_no"), F.count(F.lit(1)), F.countDistinct("member_no")).first()
    assert numbers[0] == 1 and numbers[1] == numbers[2] == numbers[3] > 32_768
    assert ids.join(more, ["c", "member_no"]).count() == ids.count()
    stored = dd.member_bitmaps(first, ids, "c", ["d", "z"]).unionByName(dd.member_bitmaps(later, more, "c", ["d", "z"]))
    stored = checkpoint_table(stored)
    for keys in (["d"], ["z"], ["d", "z"]):
        got = {tuple(r) for r in dd.distinct_members(stored, keys, "n").collect()}
        assert got == {tuple(r) for r in days.groupBy(*keys).agg(F.countDistinct("c")).collect()}
    assert dd.distinct_members(stored, [], "n").first().n == days.select("c").where("c IS NOT NULL").distinct().count()
    assert dd.distinct_members(dd.member_bitmaps(days.limit(0), ids, "c", ["d"]), ["d"], "n").count() == 0


def test_members_of_a_sparse_group_cost_a_word_each(spark):
    """A day of two members far apart among many others stores two longs, not two bitmaps as long as a bucket."""
    ids = spark.range(100_000).selectExpr("cast(id AS string) AS c", "id + 1 AS member_no")
    days = spark.createDataFrame([("d1", "5"), ("d1", "5"), ("d1", "70000"), ("d2", "5"), ("d2", None)], "d string, c string")
    stored = dd.member_bitmaps(days, ids, "c", ["d"])
    assert dict(stored.dtypes)[dd.MEMBERS] == "bigint" and stored.count() == 3
    assert dd.distinct_members(stored, [], "n").first().n == 2


def test_returned_keys_meet_by_their_order(spark):
    lines = spark.createDataFrame([(1, "1-1"), (1, "1-2"), (2, "2-1"), (3, None)], "o long, k string")
    other = spark.createDataFrame([(1, "1-2"), (1, "1-2"), (3, None), (4, "4-1")], "o long, k string")
    for within in (None, "o"):
        got = jn.exists_flag(lines, other, "k", "hit", within)
        assert got.columns.count("o") == 1
        assert {(r.k, r.hit) for r in got.collect()} == {("1-1", False), ("1-2", True), ("2-1", False), (None, False)}


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_fact_lines_are_shuffled_once(spark, no_broadcast):
    """Where orders are too large to send around, lines go by order from the first join to the returned flag."""
    from lakeplan.plans.stand_in import StandIn
    s = StandIn(spark, "/root/testdata/sf0.001")
    s.costs = s.costs.hint("broadcast")
    plan = s.fact._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert not [x for x in shuffles if "line_id" in x or "line_no" in x], shuffles
    by_order = [x for x in shuffles if "orderkey" in x or "order_id" in x]
    assert len(by_order) == 5, by_order  # lines and orders for the lines, lines and orders for the returns, order heads


def test_split_lines_add_up_and_planning_writes_narrow(spark):
    from lakeplan.operators.aggregates import DELIVERED
    from lakeplan.plans.stand_in import LINE_ORDER, PLANNING_FACT, StandIn
    whole, split = StandIn(spark, "/root/testdata/sf0.001"), StandIn(spark, "/root/testdata/sf0.001")
    split.split_lines()
    assert not set(LINE_ORDER) & set(split.lines.columns)
    assert split.lines.count() + split.lines_quarantine.count() == split.raw_lines.count() == whole.raw_lines.count()
    reasons = lambda s: {tuple(r) for r in s.lines_quarantine.groupBy("dq_reason").count().collect()}
    assert reasons(split) == reasons(whole)
    for name in ("order_id", "line_id"):
        assert {r[0] for r in split.lines.select(name).collect()} == {r[0] for r in whole.lines.select(name).collect()}
    whole.reorder
    assert whole.fact.columns == PLANNING_FACT and whole.fact.where(f"NOT ({DELIVERED})").count() == 0


def test_shares_and_allocation_start_from_written_rows(spark):
    """The rows behind a share are made once, and the weekly series and the warehouses' shares read one written fact."""
    from lakeplan.plans.catalogue.planning import allocated
    from lakeplan.plans.stand_in import StandIn
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    units = spark.range(10).selectExpr("id % 2 AS k", "id % 5 AS sku", "id AS v").groupBy("k", "sku").agg(F.sum("v").alias("v"))
    shares = wn.share_of(units, "v", ["k"])
    assert "Range" not in plan(shares)
    assert sorted((r.k, r.share) for r in shares.collect())[0] == (0, 0.0) and shares.agg(F.sum("share")).first()[0] == pytest.approx(2)
    s = StandIn(spark, "/root/testdata/sf0.001")
    out = allocated(s)
    assert "l_orderkey" not in plan(out) and out.count() > 0
    assert s.fact.where("order_status <> 'Delivered'").count() == 0


@pytest.fixture(scope="module")
def many_parts(spark, tmp_path_factory):
    """Few lines, and parts of more than the broadcast limit in files."""
    at = tmp_path_factory.mktemp("many_parts")
    tables = {
        "part": spark.range(1_500_000).selectExpr(
            "id AS p_partkey", "concat('Brand#', id % 3) AS p_brand", "IF(id % 2 = 0, 'PROMO', 'LARGE') AS p_type",
            "CAST(id % 50 + 1 AS int) AS p_size", "900 + rand(7) AS p_retailprice"),
        "orders": spark.range(40).selectExpr(
            "id AS o_orderkey", "id % 5 AS o_custkey", "'F' AS o_orderstatus", "3000D AS o_totalprice",
            "TIMESTAMP'2000-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(120).selectExpr(
            "id % 41 AS l_orderkey", "IF(id % 10 = 9, id + 1500000, id % 7 * 100003) AS l_partkey", "0L AS l_suppkey",
            "CAST(id AS int) AS l_linenumber", "2D AS l_quantity", "1000D AS l_extendedprice", "0.05D AS l_discount", "IF(id % 4 = 0, 0.07D, 0D) AS l_tax",
            "element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS int)) AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP'2000-02-01' AS l_shipdate"),
        "customer": spark.range(5).selectExpr(
            "id AS c_custkey", "'c' AS c_name", "0 AS c_nationkey", "1D AS c_acctbal", "'BUILDING' AS c_mktsegment"),
        "supplier": spark.range(1).selectExpr("id AS s_suppkey", "'s' AS s_name", "0 AS s_nationkey", "1D AS s_acctbal"),
        "nation": spark.range(1).selectExpr("CAST(id AS int) AS n_nationkey", "'NATION_0' AS n_name", "0 AS n_regionkey"),
        "region": spark.range(1).selectExpr("CAST(id AS int) AS r_regionkey", "'AFRICA' AS r_name"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def broadcasts_of(df, column):
    """Broadcasts of an executed plan whose rows are read with ``column``."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = list(itertools.takewhile(lambda x: depth(x) > depth(line), lines[i + 1:]))  # noqa: B023
            found += [line] * any(column in x for x in below)
    return found


def sku_of(p):
    return f"X-Brand#{p % 3}" if p % 50 + 1 > 45 else f"Brand#{p % 3}|{'PROMO' if p % 2 == 0 else 'LARGE'}"


def known_pairs(spark, many_parts):
    """(order, SKU) of the lines that have both."""
    lines = spark.read.parquet(f"{many_parts}/lineitem.parquet").collect()
    return {(r.l_orderkey, sku_of(r.l_partkey)) for r in lines if r.l_orderkey < 40 and r.l_partkey < 1_500_000}


def shuffled_parts(df):
    """The executed plan, of which many parts are no broadcast."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" in plan and not broadcasts_of(df, "p_partkey")
    return plan


def test_many_parts_are_not_broadcast(spark, no_broadcast, many_parts):
    """the driver would hold every part; lines meet them in a shuffle and lie by order after it, as with few parts."""
    import __spark_entry__ as entry
    want, pairs = known_pairs(spark, many_parts), entry.queries()["ded3_drop_duplicates"](spark, many_parts)
    shuffles = [x for x in shuffled_parts(pairs).splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 4, shuffles  # lines and parts, lines and orders
    got = [tuple(r) for r in pairs.select("order_id", "sku_id").collect()]
    assert len(got) == len(want) and set(got) == want


def test_orders_of_a_sku_with_many_parts(spark, no_broadcast, many_parts):
    """as F1, and an order of several such lines counts once."""
    import __spark_entry__ as entry
    want, counts = known_pairs(spark, many_parts), entry.queries()["agg5_distinct_count"](spark, many_parts)
    shuffled_parts(counts)
    assert {r.sku_id: r.orders for r in counts.collect()} == {k: sum(s == k for _, s in want) for _, k in want}


def known_lines(spark, many_parts, flag=None):
    """(line, SKU) of the lines with an order and a part."""
    lines = spark.read.parquet(f"{many_parts}/lineitem.parquet").collect()
    return [(r, sku_of(r.l_partkey)) for r in lines
            if r.l_orderkey < 40 and r.l_partkey < 1_500_000 and flag in (None, r.l_returnflag)]


def test_sales_of_many_parts(spark, no_broadcast, many_parts):
    """no part goes to the driver, and SKUs, written once, are seen to be few, so that no line is shuffled by SKU."""
    from lakeplan.plans.stand_in import StandIn
    s = StandIn(spark, many_parts)
    s.costs = s.costs.hint("broadcast")
    assert "p_type" not in s.products._jdf.queryExecution().optimizedPlan().toString()
    assert shuffled_parts(s.fact).count("hashpartitioning(sku_id") == 1  # the distinct SKUs themselves
    got = {r.sku_id: (r.lines, r.orders, r.units) for r in s.daily.collect()}
    sold = {}
    for r, sku in known_lines(spark, many_parts):
        if not sku.startswith("X-"):
            sold.setdefault(sku, []).append(r.l_orderkey)
    assert got == {sku: (len(o), len(set(o)), 2 * len(o)) for sku, o in sold.items()}


def test_stock_and_purchases_of_many_parts(spark, no_broadcast, many_parts):
    """what reorder items are made of beside the sales."""
    from lakeplan.plans.stand_in import StandIn
    s = StandIn(spark, many_parts)
    for df in (s.movements, s.pos, s.inventory):
        shuffled_parts(df)
    moved = {r.sku_id: r.n for r in s.movements.groupBy("sku_id").agg(F.sum("demand_units").alias("n")).collect() if r.n}
    want = {}
    for _, sku in known_lines(spark, many_parts, "N"):
        want[sku] = want.get(sku, 0) + 2
    assert moved == want
    assert s.pos.count() == len(known_lines(spark, many_parts, "A"))


def test_decisions_on_many_parts(spark, no_broadcast, many_parts):
    """the planner's log, which its totals join with the reorder items."""
    from lakeplan.plans.stand_in import StandIn
    s = StandIn(spark, many_parts)
    shuffled_parts(s.decisions)
    open_skus = {sku for r, sku in known_lines(spark, many_parts, "A") if r.l_tax >= 0.07}
    assert open_skus and {(r.warehouse_id, r.sku_id) for r in s.decisions.collect()} == {("WH-AFRICA", k) for k in open_skus}
