"""Expectations, quarantine, de-duplication and spelling on hand-made rows."""

from pyspark.sql import functions as F

from lakeplan.operators import expectations as ex
from lakeplan.operators.clean import arrived_late, standardise_column
from lakeplan.operators.decisions import DecisionLog
from lakeplan.operators.dedupe import dedupe, mark_duplicates
from lakeplan.plans import silver

LINE = ("line_id string, order_id string, sku_id string, quantity int, unit_price double, order_date string, batch string, "
        "seq int")


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE).withColumn("order_date", F.to_date("order_date"))


def products(spark):
    return spark.createDataFrame([("S1",), ("S2",)], "sku_id string")


FAULTY = [
    ("L1", "O1", "S1", 2, 10.0, "2024-01-31", "2024-01", 1),
    ("L1", "O1", "S1", 2, 10.0, "2024-01-31", "2024-01", 2),   # exact copy
    ("L2", "O1", "S1", -1, 10.0, "2024-01-31", "2024-01", 1),
    ("L2", "O1", "S1", -1, 10.0, "2024-01-31", "2024-01", 2),  # copy of a faulty line
    ("L3", "O2", "S9", 1, None, "2024-01-31", "2024-01", 1),   # unknown sku wins over missing price
    ("L4", "O2", "S2", 1, None, "2024-01-31", "2024-01", 1),
    ("L5", "O2", "S2", None, 5.0, "2024-01-31", "2024-01", 1),  # NULL fails its rule
    ("L6", "O3", "S2", 1, 5.0, "2024-01-31", "2024-02", 1),    # late, kept
]


def test_reasons_and_balance(spark):
    raw = lines(spark, FAULTY)
    clean, bad = silver.clean_and_rejected(raw, products(spark), [F.col("seq")])
    reasons = sorted((r.line_id, r.seq, r.dq_reason) for r in bad.collect())
    assert reasons == [
        ("L1", 2, "duplicate line"), ("L2", 1, "non-positive quantity"), ("L2", 2, "duplicate line"),
        ("L3", 1, "unknown sku"), ("L4", 1, "missing price"), ("L5", 1, "non-positive quantity")]
    kept = {r.line_id: r.arrived_late for r in clean.collect()}
    assert kept == {"L1": False, "L6": True}
    assert clean.count() + bad.count() == raw.count()


def test_silver_lines_agree_with_the_split(spark):
    raw = lines(spark, FAULTY)
    alone = silver.silver_lines(raw, products(spark), [F.col("seq")])
    assert sorted(r.line_id for r in alone.collect()) == ["L1", "L6"]


def test_exact_copies_without_a_total_order(spark):
    """A hot key of identical rows in many input tasks keeps exactly one row."""
    rows = spark.range(0, 4000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("o"))
    marked = mark_duplicates(rows, ["k"], [F.col("o")])
    counts = marked.groupBy("is_duplicate").count().collect()
    got = {r["is_duplicate"]: r["count"] for r in counts}
    assert got == {False: 1 + 2666, True: 1334 - 1}
    kept, surplus = dedupe(rows, ["k"], [F.col("o")])
    assert kept.count() == 2667 and surplus.count() == 1333


def test_orders_quarantine_catches_status_and_store(spark):
    orders = spark.createDataFrame(
        [("O1", "S", "Delivered"), ("O2", None, "Delivered"), ("O3", "S", "Lost"), ("O4", "S", None)],
        "order_id string, store_id string, order_status string")
    bad = {r.order_id: r.dq_reason for r in silver.orders_quarantine(orders).collect()}
    assert bad == {"O2": "missing store_id", "O3": "invalid status", "O4": "invalid status"}
    assert [r.order_id for r in silver.silver_orders(orders).collect()] == ["O1"]


def test_spelling_and_whitespace_count_as_corrections(spark):
    df = spark.createDataFrame([(" Tamilnadu ",), ("Tamil Nadu",), (" Goa",)], "state string")
    out = standardise_column(df, "state", silver.STATE_SPELLINGS, "fixed").collect()
    assert [(r.state, r.fixed) for r in out] == [("Tamil Nadu", True), ("Tamil Nadu", False), ("Goa", True)]


def test_warn_only_rule_keeps_rows_and_counts(spark):
    df = spark.createDataFrame([("a", "N"), ("b", None)], "store_id string, zone string")
    counted = ex.Counted(silver.RULES["stores"])
    assert ex.keep_valid(counted.watch(df), silver.RULES["stores"]).count() == 2
    assert counted.rows() == [("store_id_present", "drop", 2, 0), ("state_resolved", "warn", 1, 1)]


def test_rule_metrics_add_up(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "quantity int")
    row = ex.rule_metrics(df, [ex.Rule("q", "quantity > 0")]).first()
    assert (row.passed_rows, row.failed_rows) == (1, 2)


def test_write_split(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-1,)], "quantity int")
    ex.write_split(ex.tag(df, [ex.Rule("q", "quantity > 0")]), f"{tmp_path}/g", f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/g").count() == 1
    assert spark.read.parquet(f"{tmp_path}/b").first().dq_reason == "q"


def test_arrived_late(spark):
    df = spark.sql("SELECT DATE'2024-01-31' AS order_date, '2024-02' AS batch")
    assert df.select(arrived_late().alias("x")).first().x


def test_decision_log_keeps_all_and_shows_the_latest(spark, tmp_path):
    import datetime as dt
    log = DecisionLog(spark, f"{tmp_path}/log")
    assert log.read().count() == 0
    row = lambda d, t: [("W1", "S1", 10.0, None, d, None, "me", t)]
    log.append(row("Approved", dt.datetime(2024, 1, 1)))
    log.append(row("Rejected", dt.datetime(2024, 1, 2)))
    assert log.read().count() == 2
    assert log.latest().first().decision == "Rejected"
