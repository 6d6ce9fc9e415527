"""Sinks, incremental ingestion, refresh modes and session helpers."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lakeplan import session
from lakeplan.operators.decisions import DecisionLog
from lakeplan.operators.expectations import Rule
from lakeplan.sources import clustering, readers, rescue, writers
from lakeplan.streaming.ingest import Refresh, expect_stream, file_stream, ingest_rescued, ingest_stream

SCHEMA = "id int, qty int, batch string"


def land(spark, path, ids):
    spark.createDataFrame([(i, i - 2, "2024-01") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_ingest_reads_each_file_once(spark, tmp_path):
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    land(spark, src, [1, 2])
    ingest_stream(spark, src, SCHEMA, out, ck)
    ingest_stream(spark, src, SCHEMA, out, ck)
    assert spark.read.parquet(out).count() == 2
    land(spark, src, [3])
    ingest_stream(spark, src, SCHEMA, out, ck)
    rows = spark.read.parquet(out)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert rows.where("_source_file IS NULL OR _ingest_ts IS NULL").count() == 0


def test_stream_split_is_complete_and_repeatable(spark, tmp_path):
    src, good, bad, ck = (f"{tmp_path}/{n}" for n in ("src", "good", "bad", "ck"))
    land(spark, src, [1, 2, 3, 4])
    rules = [Rule("positive", "qty > 0", reason="non-positive")]
    for _ in range(2):
        expect_stream(file_stream(spark, src, SCHEMA), rules, good, bad, ck)
    g, b = spark.read.parquet(good), spark.read.parquet(bad)
    assert sorted(r.id for r in g.collect()) == [3, 4]
    assert {(r.id, r.dq_reason) for r in b.collect()} == {(1, "non-positive"), (2, "non-positive")}


def test_full_refresh_starts_over_and_incremental_goes_on(spark, tmp_path):
    src = f"{tmp_path}/src"
    land(spark, src, [1, 2])
    refresh = Refresh(spark, f"{tmp_path}/feeds")
    seen = []
    for full in (False, False, True):
        v = refresh.begin(full)
        out, ck = refresh.paths("f", v)
        ingest_stream(spark, src, SCHEMA, out, ck)
        seen.append((v, spark.read.parquet(out).count()))
    assert seen == [(1, 2), (1, 2), (2, 2)]


def test_partitioned_write_splits_a_hot_value(spark, tmp_path):
    """Nine tenths of the rows share one batch; it must not end in a single writer."""
    df = spark.range(200000).select("id", F.xxhash64("id").alias("x"),
                                    F.when(F.col("id") < 180000, "hot").otherwise("cold").alias("batch")).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        writers.write_partitioned(df, f"{tmp_path}/p", "batch")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{tmp_path}/p/batch=hot") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(f"{tmp_path}/p").count() == 200000


def test_fixed_file_count(spark, tmp_path):
    writers.write_files(spark.range(1000), f"{tmp_path}/n", 3)
    assert len([f for f in os.listdir(f"{tmp_path}/n") if f.endswith(".parquet")]) == 3


def test_clustered_write_separates_ranges(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("k"), "id")
    writers.write_clustered(df, f"{tmp_path}/c", ["k"], 4)
    spans = spark.read.parquet(f"{tmp_path}/c").groupBy(F.col("_metadata.file_path")).agg(
        F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert len(spans) > 1 and all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_csv_and_json_exports_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, name string")
    for fmt in ("csv", "json"):
        writers.export(df, f"{tmp_path}/{fmt}", fmt)
        back = readers.read_snapshot(spark, f"{tmp_path}/{fmt}", fmt, "id int, name string")
        assert {(r.id, r.name) for r in back.collect()} == {(1, "a,b"), (2, None)}
        assert "_source_file" in back.columns


def test_managed_table_is_replaced_with_its_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lp_test LOCATION '{tmp_path}/db'")
    writers.save_table(spark.range(3), "lp_test.t", "three rows, don't count on it")
    writers.save_table(spark.range(2).withColumn("x", F.lit("y")), "lp_test.t")
    assert readers.read_table(spark, "lp_test.t").columns == ["id", "x"]
    assert spark.table("lp_test.t").count() == 2
    spark.sql("DROP DATABASE lp_test CASCADE")


class Conf:
    def __init__(self, value):
        self.get = lambda key, default=None: value if key == "spark.checkpoint.dir" else default


class Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, value, spark):
        self.conf, self.sparkContext = Conf(value), spark.sparkContext


def test_scratch_follows_the_session_setting(spark):
    assert session.scratch_path(Session("hdfs://cluster/ckpt/", spark), "x").startswith("hdfs://cluster/ckpt/lakeplan/x-")
    unset = Session(None, spark)
    assert session.shared_dir(unset) == session.shared_dir(unset) and os.path.isdir(session.shared_dir(unset))


def test_checkpoint_table_cuts_lineage(spark):
    kept = session.checkpoint_table(spark.range(5).withColumn("r", F.rand()), "x")
    assert kept.count() == 5 and kept.collect() == kept.collect()
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_broadcast_is_hinted_only_below_the_limit(spark):
    small, plan = spark.range(10), lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(session.broadcast_if_small(small)).lower()
    assert "broadcast" not in plan(session.broadcast_if_small(small, limit=1)).lower()


@pytest.mark.parametrize("name, wanted, unwanted", [
    ("ded2_dedupe_kept", ["WindowGroupLimit"], ["CartesianProduct", "BroadcastNestedLoopJoin"]),
    ("agg10_event_uplift", [], ["CartesianProduct", "BroadcastNestedLoopJoin"]),
    ("agg9_promotion_lift", [], ["CartesianProduct", "BroadcastNestedLoopJoin"]),
    ("jon15_nearest_site", [], ["CartesianProduct", "BroadcastNestedLoopJoin"]),
    ("inv8_reorder", [], ["CartesianProduct", "BroadcastNestedLoopJoin"]),
    ("rpt5_event_daily", ["PushedFilters: [IsNotNull"], ["CartesianProduct"]),
])
def test_plan_shapes(spark, name, wanted, unwanted):
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert all(w in plan for w in wanted) and not any(u in plan for u in unwanted)


def test_append_once(spark, tmp_path):
    path, rows = f"{tmp_path}/log", spark.range(3)
    assert writers.append_once(rows, path, "a") and not writers.append_once(rows, path, "a")
    assert writers.append_once(rows, path, "b-1.c")
    assert spark.read.parquet(path).count() == 6
    for bad in ("", "_x", ".x", "a/b", "a=b", "x" * 201):
        with pytest.raises(ValueError):
            writers.append_once(rows, path, bad)


def test_append_once_from_two_threads(spark, tmp_path):
    path = f"{tmp_path}/log"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda _: writers.append_once(spark.range(100), path, "same"), range(8)))
    assert sum(won) == 1 and spark.read.parquet(path).count() == 100
    assert os.listdir(f"{path}/_appends") == [] or all(f.startswith(".") for f in os.listdir(f"{path}/_appends"))


def test_decisions_are_logged_once(spark, tmp_path):
    log = DecisionLog(spark, f"{tmp_path}/decisions")
    row = lambda d: ("W", "S", 1.0, None, d, None, "me", dt.datetime(2024, 1, 1))
    assert log.append([row("Approved"), row("Rejected")]) and not log.append([row("Rejected"), row("Approved")])
    assert log.append([row("Approved")]) and log.append([row("Approved")], "second-call") and not log.append([row("Other")], "second-call")
    assert log.read().count() == 4 and log.latest().count() == 1


def test_landing_files_that_differ_lose_nothing(spark, tmp_path):
    """An extra column, a wrong type and a missing column arrive one after the other; all rows and values stay."""
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    schema = "id int, qty int, batch string"
    land(spark, src, [1, 2])
    ingest_rescued(spark, src, schema, out, ck)
    for sql in ("SELECT 3 AS id, 7 AS qty, 'b' AS batch, 'red' AS colour, named_struct('x', 1.5D) AS more", "SELECT 4 AS id, 'many' AS qty, 'b' AS batch",
                "SELECT 5 AS id, '12' AS qty, 'b' AS batch", "SELECT 6L AS id, 'b' AS batch", "SELECT 9999999999L AS id, 1 AS qty, 'b' AS batch"):
        spark.sql(sql).write.mode("append").parquet(src)
    for _ in range(2):
        ingest_rescued(spark, src, schema, out, ck)
    rows = spark.read.parquet(out).collect()
    assert {(r.id, r.qty): r._rescued for r in rows if r._rescued is None or "999" not in r._rescued} == {
        (1, -1): None, (2, 0): None, (3, 7): '{"colour":"red","more":{"x":1.5}}', (4, None): '{"qty":"many"}', (5, 12): None, (6, None): None}
    assert [r._rescued for r in rows if r.qty == 1] == ['{"id":9999999999}'] and len(rows) == 7
    assert all(r._source_file.endswith(".parquet") and r._ingest_ts for r in rows)


def test_snapshots_that_differ_lose_nothing(spark, tmp_path):
    csv, json = f"{tmp_path}/csv", f"{tmp_path}/json"
    os.makedirs(csv), os.makedirs(json)
    for name, text in (("a.csv", "id,name\n1,x\n2,\n"), ("b.csv", "name,id,colour\ny,3,red\nz,four,\n")):
        with open(f"{csv}/{name}", "w") as f:
            f.write(text)
    got = rescue.read_snapshot_rescued(spark, csv, "csv", "id int, name string").collect()
    assert {(r.id, r.name, r._rescued) for r in got} == {(1, "x", None), (2, None, None), (3, "y", '{"colour":"red"}'), (None, "z", '{"id":"four"}')}
    with open(f"{json}/a.json", "w") as f:
        f.write('{"id": 1, "name": "x"}\n{"id": "two", "more": {"k": [1, 2]}}\nnot json\n')
    rows = {r.id: r._rescued for r in rescue.read_snapshot_rescued(spark, json, "json", "id int, name string").where("id = 1 OR _rescued LIKE '%two%'").collect()}
    assert rows[1] is None and '"id":"two"' in rows[None] and '"k":["1","2"]' in rows[None]
    broken = rescue.read_snapshot_rescued(spark, json, "json", "id int, name string").where("_rescued LIKE '%not json%'").collect()
    assert len(broken) == 1 and broken[0].id is None
    assert rescue.read_snapshot_rescued(spark, f"{tmp_path}/none", "csv", "id int").count() == 0


def scanned(df):
    """Rows that the scan of an executed plan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_a_filter_on_the_second_column_skips_files(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("date_add(DATE'2020-01-01', CAST(pmod(hash(id), 1000) AS int)) AS d",
                                          "concat('k', format_string('%04d', pmod(hash(id, 1), 3000))) AS k", "id")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS date) AS d, 'k0001' AS k, -1L AS id"))
    cuts = clustering.quantile_cuts(rows, ["d", "k"])
    clustering.write_interleaved(rows, f"{tmp_path}/z", cuts, 16)
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.count() == 40_001 and back.exceptAll(rows).count() == 0
    files = back.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("a"), F.max("k").alias("b"))
    stats = files.collect()
    assert len(stats) == 16 and max(r.n for r in stats) < 2 * 40_000 / 16, "the parts are equal to each other"
    assert sum(r.a <= "k1500" <= r.b for r in stats) <= 8
    for only in ("k = 'k1500'", "d = DATE'2021-06-01'"):
        assert scanned(back.where(only)) <= 20_000, only


def test_interleaved_key_and_parts(spark):
    assert [r[0] for r in spark.sql("SELECT * FROM VALUES (0, 0), (1, 0), (0, 1), (3, 1), (255, 255) t(a, b)").select(
        clustering.interleaved([F.col("a"), F.col("b")])).collect()] == [0, 2, 1, 11, 65535]
    for n in (1, 2, 7, 64):
        parts = clustering.numbers_by_part(spark, n)
        got = spark.createDataFrame([(i,) for i in parts], "i int").select(F.pmod(F.hash("i"), F.lit(n))).collect()
        assert [r[0] for r in got] == list(range(n))
    empty = spark.sql("SELECT CAST(NULL AS date) AS d, CAST(NULL AS string) AS k WHERE false")
    assert clustering.quantile_cuts(empty, ["d", "k"]) == {"d": [], "k": []}
