"""Sources, sinks and streams (SRC, SNK, STR)."""

import uuid

from pyspark.sql import functions as F

from lakeplan.functions.calendar import spine_of
from lakeplan.functions.columns import month_start
from lakeplan.operators.aggregates import DAILY_INPUT, sales_daily
from lakeplan.operators.decisions import DecisionLog
from lakeplan.operators.expectations import Rule
from lakeplan.operators.refresh import replace_partitions, touched_months, within
from lakeplan.plans.catalogue import query
from lakeplan.plans.runner import Lake
from lakeplan.plans.stand_in import CHANNELS
from lakeplan.session import checkpoint_table, scratch_path
from lakeplan.sources import clustering, readers, rescue, writers
from lakeplan.streaming.ingest import Refresh, expect_stream, file_stream, ingest_stream

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]
EVENT_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
EVENT_RULES = [
    Rule("positive_value", "value > 1", reason="value too small"),
    Rule("known_type", "event_type <> 'error'", reason="error event"),
]


def ingested(s):
    """One triggered run over the events file; the output folder is new each time."""
    out = scratch_path(s.spark, "ingest")
    ingest_stream(s.spark, s.dir, s.events_tbl.schema, f"{out}/rows", f"{out}/ckpt", pattern="events.parquet")
    return s.spark.read.parquet(f"{out}/rows")


@query("src1_incremental_ingest", EVENT_SQL)
def src1(s):
    return ingested(s).select(*EVENT_COLUMNS)


@query("src2_lineage", "SELECT event_id, 'events.parquet' AS file_name, true AS has_ingest_time FROM events")
def src2(s):
    df = readers.with_lineage(s.events_tbl)
    return df.select("event_id", F.element_at(F.split("_source_file", "/"), -1).alias("file_name"),
                     F.col("_ingest_ts").isNotNull().alias("has_ingest_time"))


def round_trip(s, df, fmt):
    path = scratch_path(s.spark, fmt)
    writers.export(df, path, fmt)
    return readers.read_snapshot(s.spark, path, fmt, df.schema, lineage=False)


@query("src3_json_snapshot", "SELECT * FROM part")
def src3(s):
    return round_trip(s, s.part, "json")


@query("src4_csv_snapshot", "SELECT * FROM supplier")
def src4(s):
    return round_trip(s, s.supplier, "csv")


@query("src5_table_read", "SELECT p_type, count(*) AS n, max(p_size) AS max_size FROM part GROUP BY p_type")
def src5(s):
    return readers.read_table(s.spark, "part.parquet", s.dir).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("p_size").alias("max_size"))


@query("src6_date_spine", """SELECT g.date, count(o.o_orderkey) AS orders FROM (
    SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders) g
    LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = g.date GROUP BY g.date""")
def src6(s):
    days = s.raw_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    span = days.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    spine = spine_of(span, "a", "b", name="date").select("date")
    return spine.join(days, F.col("date") == F.col("order_date"), "left").select(
        "date", F.coalesce("n", F.lit(0)).alias("orders"))


@query("src7_integer_range", """SELECT CAST(r.q AS BIGINT) AS quantity, count(l_orderkey) AS lines
    FROM range(1, 61) r(q) LEFT JOIN lineitem ON CAST(l_quantity AS BIGINT) = r.q GROUP BY r.q""")
def src7(s):
    lines = s.lineitem.groupBy(F.col("l_quantity").cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return s.spark.range(1, 61).join(lines, "id", "left").select(
        F.col("id").alias("quantity"), F.coalesce("n", F.lit(0)).alias("lines"))


@query("src8_inline_table", """SELECT c.channel_name, c.channel_group, count(*) AS orders FROM orders
    JOIN s_channels c ON o_orderpriority = c.channel_code GROUP BY ALL""")
def src8(s):
    table = readers.inline_table(s.spark, CHANNELS, "channel_code string, channel_name string, channel_group string")
    counts = s.raw_orders.groupBy("channel_code").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(table, "channel_code").select("channel_name", "channel_group", "orders")


@query("snk1_partitioned_write", "SELECT strftime(l_shipdate, '%Y-%m') AS batch, count(*) AS rows, "
       "CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY 1")
def snk1(s):
    path = scratch_path(s.spark, "by_batch")
    rows = s.lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                             F.date_format("l_shipdate", "yyyy-MM").alias("batch"))
    writers.write_partitioned(rows, path, "batch")
    back = s.spark.read.schema(rows.schema).parquet(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").cast("long").alias("units"))


@query("snk2_fixed_files", "SELECT count(*) AS rows, CAST(4 AS BIGINT) AS files FROM orders")
def snk2(s):
    path = scratch_path(s.spark, "files")
    writers.write_files(s.orders_tbl, path, 4)
    back = s.spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path"))
    return back.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("f").alias("files"))


@query("snk3_export", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def snk3(s):
    return round_trip(s, s.customer.select("c_custkey", "c_name", "c_acctbal"), "csv")


@query("snk6_append_log", "SELECT warehouse_id, sku_id, decision, override_units FROM s_decisions")
def snk6(s):
    """The decision log, whose batches come twice each, once under a key and once known by their rows."""
    log = DecisionLog(s.spark, scratch_path(s.spark, "log"))
    rows = s.decisions.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("recommended_order_units", "double"), ("comment", "string"), ("decided_by", "string"))])
    for side, key in (("decision = 'Approved'", "approved"), ("decision <> 'Approved'", None)):
        for _ in range(2):
            log.append(rows.where(side), key)
    return log.read().select("warehouse_id", "sku_id", "decision", "override_units")


@query("snk7_lineage_cut", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def snk7(s):
    kept = checkpoint_table(s.orders_tbl.select("o_orderpriority", "o_orderkey"), "cut")
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("snk8_clustered_write", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders "
       "WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def snk8(s):
    path = scratch_path(s.spark, "clustered")
    rows = s.orders_tbl.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    writers.write_clustered(rows, path, ["order_date", "o_orderkey"])
    return s.spark.read.parquet(path).where("order_date >= DATE'2000-01-01'")


@query("snk8_interleaved_write", """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE o_custkey <= 40""")
def snk8_interleaved(s):
    """Clustered on date and customer; the filter is on the second column alone."""
    path = scratch_path(s.spark, "interleaved")
    rows = s.orders_tbl.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    clustering.write_interleaved(rows, path, clustering.quantile_cuts(rows, ["order_date", "o_custkey"]), 16)
    return s.spark.read.parquet(path).where("o_custkey <= 40")


@query("src4_rescued_fields", """SELECT s_suppkey, s_name, CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS DOUBLE) AS balance, CASE WHEN s_suppkey % 2 = 0
    THEN NULL ELSE 'unknown' END AS refused, CAST(s_nationkey AS VARCHAR) AS extra FROM supplier""")
def src4_rescued(s):
    """A snapshot with a column that is not declared, and with values that are not of their type."""
    path = scratch_path(s.spark, "odd")
    odd = s.supplier.select("s_suppkey", "s_name", F.expr("CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_acctbal AS string) ELSE 'unknown' END").alias("balance"),
                            F.col("s_nationkey").alias("extra"))
    writers.export(odd, path, "csv")
    kind = s.supplier.schema["s_suppkey"].dataType.simpleString()
    back = rescue.read_snapshot_rescued(s.spark, path, "csv", f"s_suppkey {kind}, s_name string, balance double")
    return back.select("s_suppkey", "s_name", "balance", F.get_json_object(rescue.RESCUED, "$.balance").alias("refused"),
                       F.get_json_object(rescue.RESCUED, "$.extra").alias("extra"))


@query("str1_append_new_files", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def str1(s):
    """Two triggered runs over the same folder; the second finds nothing new."""
    out = scratch_path(s.spark, "twice")
    for _ in range(2):
        ingest_stream(s.spark, s.dir, s.events_tbl.schema, f"{out}/rows", f"{out}/ckpt", pattern="events.parquet")
    return s.spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def split_stream(s):
    out = scratch_path(s.spark, "split")
    stream = file_stream(s.spark, s.dir, s.events_tbl.schema, pattern="events.parquet")
    expect_stream(stream, EVENT_RULES, f"{out}/good", f"{out}/bad", f"{out}/ckpt")
    return s.spark.read.parquet(f"{out}/good"), s.spark.read.parquet(f"{out}/bad")


REJECT_SQL = "CASE WHEN value > 1 THEN CASE WHEN event_type <> 'error' THEN NULL ELSE 'error event' END ELSE 'value too small' END"


@query("str2_typed_stream", EVENT_SQL + " WHERE value > 1 AND event_type <> 'error'")
def str2(s):
    return split_stream(s)[0].select(*EVENT_COLUMNS)


@query("str3_reject_stream", f"SELECT event_id, {REJECT_SQL} AS dq_reason FROM events WHERE {REJECT_SQL} IS NOT NULL")
def str3(s):
    return split_stream(s)[1].select("event_id", "dq_reason")


@query("exp5_stream_dual_output", f"""SELECT coalesce({REJECT_SQL}, 'accepted') AS outcome, count(*) AS rows
    FROM events GROUP BY 1""")
def exp5(s):
    good, bad = split_stream(s)
    both = good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.col("dq_reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query("str4_late_data", """SELECT batch, arrived_late, count(*) AS lines FROM s_lines GROUP BY ALL""")
def str4(s):
    return s.lines.groupBy("batch", "arrived_late").agg(F.count(F.lit(1)).alias("lines"))


@query("str5_batch_dedupe_of_stream", "SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL")
def str5(s):
    """Global de-duplication runs in batch over the whole stream table."""
    from lakeplan.operators.dedupe import latest_per_key
    return latest_per_key(ingested(s), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


def through_table(s, frames, comment=None):
    """Save frames one after the other under one new managed table; its rows and comment, and the table is gone again."""
    name = f"lakeplan_{uuid.uuid4().hex}"
    try:
        for df in frames:
            writers.save_table(df, name, comment)
        note = s.spark.catalog.getTable(name).description
        return checkpoint_table(s.spark.table(name).withColumn("note", F.lit(note)), "managed")
    finally:
        s.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("snk4_managed_table", "SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS note FROM orders")
def snk4(s):
    """Saved twice; the second schema replaces the first."""
    return through_table(s, [s.nation, s.orders_tbl.select("o_orderkey", "o_totalprice")])


@query("snk5_table_comment", """SELECT c_custkey, 'customers'' keys \\ "all"' AS note FROM customer""")
def snk5(s):
    return through_table(s, [s.customer.select("c_custkey")], """customers' keys \\ "all\"""")


@query("snk4_run_tables", """SELECT order_date, sku_id, zone, channel_code, units, net_revenue, 'daily' AS kind FROM s_daily WHERE order_date >= DATE'1998-01-01'
    UNION ALL SELECT order_date, NULL, NULL, NULL, count(*), NULL, 'lines' FROM s_fact WHERE order_date >= DATE'1998-01-01' GROUP BY order_date""")
def snk4_run(s):
    """Tables of a run, asked by their names in the catalog; a month is replaced in between."""
    lake = Lake(s.spark, scratch_path(s.spark, "named"), f"lakeplan_{uuid.uuid4().hex}")
    try:
        fact = lake.refresh("gold", "fact_sales_line", s.fact.where("order_date >= DATE'1998-01-01'"), None)
        lake.refresh("gold", "agg_sales_daily", sales_daily(fact.where("month(order_date) <> 3"), s.channels), None)
        months = touched_months(fact.where("month(order_date) = 3"), "order_date")
        lake.refresh("gold", "agg_sales_daily", sales_daily(fact.where(within("order_date", months)), s.channels), months)
        return checkpoint_table(s.spark.sql(f"""SELECT order_date, sku_id, zone, channel_code, units, net_revenue, 'daily' AS kind FROM {lake.database}.gold_agg_sales_daily
            UNION ALL SELECT order_date, NULL, NULL, NULL, count(*), NULL, 'lines' FROM {lake.database}.gold_fact_sales_line GROUP BY order_date"""), "named")
    finally:
        s.spark.sql(f"DROP DATABASE IF EXISTS {lake.database} CASCADE")


@query("snk9_refresh_modes", "SELECT CAST(v AS INTEGER) AS version, event_type, count(*) AS n FROM events, (VALUES (1), (2)) r(v) GROUP BY ALL")
def snk9(s):
    """Two incremental runs share a version and its rows; a full refresh starts the next one."""
    refresh, found = Refresh(s.spark, scratch_path(s.spark, "refresh")), {}
    for full in (False, False, True):
        version = refresh.begin(full)
        out, ckpt = refresh.paths("events", version)
        ingest_stream(s.spark, s.dir, s.events_tbl.schema, out, ckpt, pattern="events.parquet")
        found[version] = out
    rows = [s.spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(F.lit(v).alias("version"), "event_type", "n")
            for v, out in found.items()]
    return rows[0].unionByName(rows[1])


@query("snk9_touched_months", "SELECT * FROM s_daily")
def snk9_months(s):
    """The daily aggregate refreshed by month: without two periods first, then with the lines that come later."""
    path = scratch_path(s.spark, "daily")
    fact = checkpoint_table(s.fact.select("line_id", *DAILY_INPUT).withColumn("order_month", month_start("order_date")), "fact_months")
    arrived_first = "order_date < DATE'2001-01-01' AND NOT (month(order_date) = 3 AND pmod(hash(line_id), 5) = 0)"
    for rows, months in ((fact.where(arrived_first), None), (fact, touched_months(fact.where(f"NOT ({arrived_first})"), "order_date"))):
        daily = sales_daily(rows.where(within("order_date", months)), s.channels).withColumn("order_month", month_start("order_date"))
        replace_partitions(daily, path, "order_month", months, ["order_date", "zone"])
    return s.spark.read.parquet(path).drop("order_month")
