"""Scalar function families (FN)."""

from pyspark.sql import functions as F

from lakeplan.functions.columns import md5_bucket, ratio, week_start
from lakeplan.plans.catalogue import query
from lakeplan.plans.oracle import R, month, week


@query("fn1_strings", """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, split_part(p_name, ' ', 1) AS first_word,
    right(p_brand, 2) AS tail, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, substring(p_type, 1, 3) AS head,
    p_brand || '-' || p_type AS joined, printf('SKU-%05d', p_partkey) AS code, p_name LIKE '%ring%' AS is_ring FROM part""")
def fn1(s):
    c = F.col
    return s.part.select(
        "p_partkey", F.trim(F.concat(F.lit("  "), c("p_name"), F.lit(" "))).alias("trimmed"),
        F.split("p_name", " ")[0].alias("first_word"), F.right(c("p_brand"), F.lit(2)).alias("tail"),
        F.lpad(c("p_size").cast("string"), 4, "0").alias("padded"), F.substring("p_type", 1, 3).alias("head"),
        F.concat_ws("-", "p_brand", "p_type").alias("joined"), F.format_string("SKU-%05d", "p_partkey").alias("code"),
        c("p_name").like("%ring%").alias("is_ring"))


@query("fn2_dates", f"""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
    {week('o_orderdate')} AS wk, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week, CAST(month(o_orderdate) AS INTEGER) AS m,
    CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(year(o_orderdate) AS INTEGER) AS y, {month('o_orderdate')} AS month_start,
    CAST(dayofmonth(o_orderdate) AS INTEGER) AS dom, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_left,
    CAST(o_orderdate AS DATE) - 28 AS back_28, CAST(o_orderdate AS DATE) + 84 AS ahead_84,
    CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month FROM orders""")
def fn2(s):
    d = F.to_date("o_orderdate")
    return s.orders_tbl.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"), F.dayofweek(d).alias("dow"),
        week_start(d).alias("wk"), F.weekofyear(d).alias("iso_week"), F.month(d).alias("m"), F.quarter(d).alias("q"),
        F.year(d).alias("y"), F.trunc(d, "month").alias("month_start"), F.dayofmonth(d).alias("dom"),
        F.date_diff(F.lit("2001-12-31").cast("date"), d).alias("days_left"), F.date_sub(d, 28).alias("back_28"),
        F.date_add(d, 84).alias("ahead_84"), F.add_months(d, 1).alias("next_month"))


@query("fn3_math", f"""SELECT c_custkey, {R('c_acctbal', 0)} AS rounded, CAST(floor(c_acctbal) AS BIGINT) AS floored,
    CAST(ceil(c_acctbal) AS BIGINT) AS ceiled, abs(c_acctbal) AS magnitude, {R('sqrt(abs(c_acctbal))', 6)} AS root,
    greatest(c_acctbal, 0) AS at_least_0, least(c_acctbal, 5000) AS at_most_5000,
    {R('power(c_acctbal / 1000, 2)', 6)} AS squared, {R('ln(abs(c_acctbal) + 1)', 6)} AS logged,
    {R('exp(c_acctbal / 10000)', 6)} AS grown, c_nationkey % 7 AS remainder FROM customer""")
def fn3(s):
    b = F.col("c_acctbal")
    return s.customer.select(
        "c_custkey", F.round(b, 0).alias("rounded"), F.floor(b).alias("floored"), F.ceil(b).alias("ceiled"),
        F.abs(b).alias("magnitude"), F.round(F.sqrt(F.abs(b)), 6).alias("root"),
        F.greatest(b, F.lit(0.0)).alias("at_least_0"), F.least(b, F.lit(5000.0)).alias("at_most_5000"),
        F.round(F.pow(b / 1000, F.lit(2.0)), 6).alias("squared"), F.round(F.log(F.abs(b) + 1), 6).alias("logged"),
        F.round(F.exp(b / 10000), 6).alias("grown"), (F.col("c_nationkey") % 7).alias("remainder"))


@query("fn4_conditionals", f"""SELECT order_id, coalesce(store_id, -1) AS store_or_none, nullif(payment_mode, 'Cash') AS on_credit,
    CASE WHEN customer_id IS NULL THEN 'unknown' ELSE 'known' END AS buyer, coalesce(customer_id, 'none') AS customer_filled,
    {R('1 / nullif(CAST(CASE WHEN store_id IS NULL THEN 0 ELSE 4 END AS DOUBLE), 0)', 4)} AS safe FROM s_raw_orders""")
def fn4(s):
    c = F.col
    out = s.raw_orders.select(
        "order_id", F.coalesce("store_id", F.lit(-1)).alias("store_or_none"),
        F.nullif(c("payment_mode"), F.lit("Cash")).alias("on_credit"),
        F.when(c("customer_id").isNull(), "unknown").otherwise("known").alias("buyer"),
        c("customer_id").alias("customer_filled"),
        F.round(ratio(F.lit(1), F.when(c("store_id").isNull(), 0).otherwise(4)), 4).alias("safe"))
    return out.fillna({"customer_filled": "none"})


@query("fn5_arrays_and_maps", """SELECT c_custkey, CAST(i.pos AS INTEGER) AS pos, CASE i.pos WHEN 1 THEN c_name ELSE c_mktsegment END AS label,
    c_name || ' / ' || c_mktsegment AS both_names, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS mapped
    FROM customer, range(1, 3) i(pos)""")
def fn5(s):
    codes = F.create_map(F.lit("BUILDING"), F.lit(1), F.lit("MACHINERY"), F.lit(2))
    out = s.customer.withColumn("names", F.array("c_name", "c_mktsegment")).withColumn(
        "pos", F.explode(F.sequence(F.lit(1), F.lit(2))))
    return out.select("c_custkey", "pos", F.element_at("names", F.col("pos")).alias("label"),
                      F.array_join("names", " / ").alias("both_names"), F.coalesce(codes[F.col("c_mktsegment")], F.lit(0)).alias("mapped"))


@query("fn6_hash_spread", """SELECT CAST(('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 8))::BIGINT % 16 AS INTEGER) AS bucket,
    count(*) AS orders FROM orders GROUP BY 1""")
def fn6(s):
    """Rows per hash bucket of the order key, by a hash that other engines have too."""
    bucket = md5_bucket(16, "o_orderkey").alias("bucket")
    return s.orders_tbl.groupBy(bucket).agg(F.count(F.lit(1)).alias("orders"))


@query("fn7_control", "SELECT order_id, 'ok' AS verdict, true AS has_time FROM s_raw_orders")
def fn7(s):
    verdict = F.when(F.col("order_id") < 0, F.raise_error(F.lit("negative order key")).cast("string")).otherwise("ok")
    return s.raw_orders.select("order_id", verdict.alias("verdict"), F.current_timestamp().isNotNull().alias("has_time"))


@query("fn8_casts", """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS as_text, CAST(p_size AS DOUBLE) AS as_double,
    TRY_CAST(p_brand AS INTEGER) IS NULL AS not_a_number, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
    TRY_CAST('2001-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DATE) AS maybe_date FROM part""")
def fn8(s):
    c = F.col
    day = F.concat(F.lit("2001-02-"), F.lpad(c("p_size").cast("string"), 2, "0"))
    return s.part.select(
        "p_partkey", c("p_partkey").cast("string").alias("as_text"), c("p_size").cast("double").alias("as_double"),
        c("p_brand").try_cast("int").isNull().alias("not_a_number"), F.substring("p_brand", 7, 9).try_cast("int").alias("brand_no"),
        day.try_cast("date").alias("maybe_date"))
