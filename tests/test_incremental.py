"""A second run computes the months that it touches, and only these."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeplan.operators import refresh as rf
from lakeplan.plans import runner
from tests.test_end_to_end import CFG, RAW_TYPES, land

BY_MONTH = {"fact_sales_line": "order_month", "fact_orders": "order_month", "agg_sales_daily": "order_month", "agg_sales_monthly": "month",
            "agg_sales_weekly": "week_month"}


def files(lake):
    """(table, month): names and times of its files."""
    out = {}
    for name, partition in BY_MONTH.items():
        root = lake.path("gold", name)
        for folder in os.listdir(root):
            if folder.startswith(f"{partition}="):
                out[name, folder.split("=")[1]] = {(f, os.stat(f"{root}/{folder}/{f}").st_mtime_ns) for f in os.listdir(f"{root}/{folder}")}
    return out


def changed(before, after):
    return {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def layers(lake, landing, full=False):
    version = runner.bronze(lake, landing, full, RAW_TYPES)
    runner.silver_layer(lake, version, raw_types=RAW_TYPES)
    return runner.gold_layer(lake, version, CFG, RAW_TYPES)


def rows(lake, name):
    df = lake.table("gold", name)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("months")
    land(spark, f"{base}/landing")
    out = runner.Lake(spark, f"{base}/root")
    out.landing = f"{base}/landing"
    assert layers(out, out.landing) is None, "the first run computes everything"
    return out


def add(spark, landing, feed, df):
    have = spark.read.parquet(f"{landing}/{feed}")
    df.select(*[F.col(c).cast(t) for c, t in have.dtypes]).write.mode("append").parquet(f"{landing}/{feed}")


def same_as_full(spark, lake, tmp_path):
    other = runner.Lake(spark, f"{tmp_path}/full")
    layers(other, lake.landing)
    for name in BY_MONTH:
        assert rows(lake, name) == rows(other, name), name


def test_nothing_new_touches_nothing(lake):
    before = files(lake)
    assert layers(lake, lake.landing) == []
    assert changed(before, files(lake)) == set()


def test_new_month_late_line_and_late_return(spark, lake, tmp_path):
    lines, orders = (spark.read.parquet(f"{lake.landing}/{f}") for f in ("sales_lines", "orders"))
    july = F.expr("add_months(order_date, 1)")
    new = lines.where("order_date BETWEEN DATE'2024-06-10' AND DATE'2024-06-20'").withColumns(
        {"line_id": F.concat("line_id", F.lit("n")), "order_id": F.concat("order_id", F.lit("n")), "order_date": july, "batch": F.lit("2024-07")})
    late = lines.where("line_id = 'L100-1'").withColumns({"line_id": F.lit("LATE"), "order_date": F.lit("2023-03-01").cast("date"), "batch": F.lit("2024-07")})
    heads = orders.where("to_date(order_ts) BETWEEN DATE'2024-06-10' AND DATE'2024-06-20'").withColumn("order_id", F.concat("order_id", F.lit("n")))
    add(spark, lake.landing, "sales_lines", new.unionByName(late))
    add(spark, lake.landing, "orders", heads)
    back = spark.read.parquet(f"{lake.landing}/returns").where("return_id = 'R1'").withColumns({"return_id": F.lit("R9"), "line_id": F.lit("L320-2"), "order_id": F.lit("O320")})
    returned = lines.where("line_id = 'L320-2'").first().order_date.replace(day=1)
    add(spark, lake.landing, "returns", back)
    before = files(lake)
    months = layers(lake, lake.landing)
    assert months == sorted({dt.date(2023, 3, 1), returned, dt.date(2024, 7, 1)})
    touched = changed(before, files(lake))
    for name in BY_MONTH:
        want = rf.week_months(months) if name == "agg_sales_weekly" else months
        assert {m for n, m in touched if n == name} == {m.isoformat() for m in want}, name
    assert lake.table("gold", "fact_sales_line").where("line_id = 'LATE'").count() == 1
    assert lake.table("gold", "fact_sales_line").where("line_id = 'L320-2'").first().is_returned
    same_as_full(spark, lake, tmp_path)
    assert layers(lake, lake.landing) == []


def test_a_run_that_fails_leaves_its_months_to_the_next(spark, lake, tmp_path, monkeypatch):
    one = spark.read.parquet(f"{lake.landing}/sales_lines").where("line_id = 'L200-1'").withColumn("line_id", F.lit("AGAIN"))
    add(spark, lake.landing, "sales_lines", one)
    month = one.first().order_date.replace(day=1)
    with monkeypatch.context() as patch:
        patch.setattr(runner.ag, "sales_weekly", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers(lake, lake.landing)
    assert layers(lake, lake.landing) == [month]
    same_as_full(spark, lake, tmp_path)


def test_a_changed_snapshot_makes_everything_anew(spark, lake):
    spark.sql("SELECT 'GT' channel_code, 'Renamed' channel_name, 'Offline' channel_group, 0.1 partner_margin_pct").write.mode(
        "overwrite").option("header", True).csv(f"{lake.landing}/channels")
    assert layers(lake, lake.landing) is None
    assert {r[0] for r in lake.table("gold", "agg_sales_daily").select("channel_name").distinct().collect()} == {"Renamed"}


def test_emptied_month_loses_its_folder(spark, tmp_path):
    def table(sql):
        return spark.sql(f"SELECT *, trunc(d, 'MM') AS m FROM VALUES {sql} t(d, v)")

    path, jan, feb = f"{tmp_path}/t", dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rf.replace_partitions(table("(DATE'2024-01-05', 1), (DATE'2024-02-05', 2)"), path, "m", None, ["d"])
    rf.replace_partitions(table("(DATE'2024-02-06', 3)"), path, "m", [jan, feb], ["d"])
    assert [(r.v, r.m) for r in spark.read.parquet(path).collect()] == [(3, feb)]


def test_month_and_week_ranges(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-11-01', DATE'2024-04-30')) AS d")
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2023, 11, 1)]
    assert days.where(rf.within("d", months)).count() == 31 + 29 + 30 == days.where("trunc(d, 'MM') IN (DATE'2024-01-01', DATE'2024-02-01', DATE'2023-11-01')").count()
    assert days.where(rf.within("d", [])).count() == 0 and days.where(rf.within("d", None)).count() == days.count()
    week = "CAST(date_trunc('week', d) AS date)"
    assert rf.week_months([dt.date(2024, 2, 1)]) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    got = days.where(rf.within_weeks("d", [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]))
    assert got.count() == days.where(f"trunc({week}, 'MM') IN (DATE'2024-01-01', DATE'2024-02-01')").count()


@pytest.fixture
def database(spark):
    yield "lakeplan_named"
    spark.sql("DROP DATABASE IF EXISTS lakeplan_named CASCADE")


def test_tables_of_a_run_by_name(spark, tmp_path, database):
    lake = runner.Lake(spark, str(tmp_path / "it's"), database)
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-03-31')) AS order_date, 'N' AS zone")
    name = f"{database}.gold_agg_sales_daily"
    lake.refresh("gold", "agg_sales_daily", days, None)
    assert spark.table(name).count() == 91
    assert spark.catalog.getTable(name).description == runner.COMMENTS["gold", "agg_sales_daily"]
    lake.refresh("gold", "agg_sales_daily", days.where("order_date = DATE'2024-02-03'"), [dt.date(2024, 2, 1)])
    assert spark.table(name).count() == 91 - 29 + 1
    later = days.withColumn("order_date", F.add_months("order_date", 3)).where("month(order_date) = 5")
    lake.refresh("gold", "agg_sales_daily", later, [dt.date(2024, 5, 1)])
    assert spark.table(name).where("month(order_date) = 5").count() == 29
    lake.refresh("gold", "agg_sales_daily", days.where("month(order_date) = 1"), None)
    assert spark.table(name).count() == 31 and spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_a_name_follows_new_columns_and_new_folders(spark, tmp_path, database):
    name, rows = f"{database}.gold_dim_store", spark.range(3)
    lake = runner.Lake(spark, str(tmp_path / "one"), database)
    lake.save("gold", "dim_store", rows)
    lake.save("gold", "dim_store", rows.withColumn("zone", F.lit("N")))
    assert spark.table(name).columns == ["id", "zone"]
    other = runner.Lake(spark, str(tmp_path / "two"), database)
    other.save("gold", "dim_store", spark.range(5).withColumn("zone", F.lit("S")))
    assert spark.table(name).where("zone = 'S'").count() == 5
    assert lake.table("gold", "dim_store").count() == 3
