"""Streaming runs over the tables' files; each must end where the batch form does."""

from pyspark.sql import functions as F

from quayside.functions.exact import exact_sum
from quayside.operators import quality as Q
from quayside.queries import commerce as C
from quayside.queries.registry import query
from quayside.queries.sqltext import money, total
from quayside.session import scratch_path
from quayside.streaming import incremental as I


def arriving(t, name):
    """The table's files as a stream: the files of its folder, or the one file it is."""
    path = t.spark._jvm.org.apache.hadoop.fs.Path(t.path(name))
    files = path.getFileSystem(t.spark._jsc.hadoopConfiguration())
    schema = getattr(t, name).schema
    if files.getFileStatus(path).isDirectory():
        return I.arriving_files(t.spark, t.path(name), schema)
    return I.arriving_files(t.spark, t.folder, schema, name_filter=f"{name}.parquet")


@query("st_running_totals", f"SELECT {total('l_extendedprice')} AS total, COUNT(*) AS rows FROM lineitem")
def st_running_totals(t):
    out = scratch_path(t.spark, "running")
    I.running_totals(
        arriving(t, "lineitem"), f"{out}/totals", f"{out}/checkpoint",
        exact_sum("l_extendedprice").alias("total"), F.count(F.lit(1)).alias("rows"),
    )
    return I.latest_totals(t.spark, f"{out}/totals")


@query("st_quarantine", """
SELECT o_orderkey, o_totalprice >= 5000 AND o_orderpriority <> '5-LOW' AS is_valid,
  CONCAT_WS('; ', CASE WHEN o_totalprice < 5000 THEN 'Total too low' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'Invalid priority: 5-LOW' END) AS errors
FROM orders
""")
def st_quarantine(t):
    rules = Q.RuleSet(
        required=["o_orderkey", "o_totalprice"],
        errors=[
            (F.col("o_totalprice") < 5000, "Total too low"),
            (F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("Invalid priority: "), F.col("o_orderpriority"))),
        ],
    )
    out = scratch_path(t.spark, "quarantine")
    I.quarantine(arriving(t, "orders"), lambda df: Q.check(df, rules), f"{out}/records", f"{out}/checkpoint")
    saved = t.spark.read.parquet(f"{out}/records")
    return saved.select("o_orderkey", F.col("is_valid").cast("boolean").alias("is_valid"), F.array_join("errors", "; ").alias("errors"))


@query("st_daily_revenue", f"""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(DISTINCT o_orderkey) AS order_count, COUNT(DISTINCT o_custkey) AS unique_customers,
  SUM({money('o_totalprice')}) AS rev FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT order_date, order_count, unique_customers, CAST(rev AS DOUBLE) AS daily_revenue,
  CAST(SUM(rev) OVER (ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_revenue FROM d
""")
def st_daily_revenue(t):
    class Arriving:
        orders = arriving(t, "orders")

    out = scratch_path(t.spark, "daily")
    I.refresh_daily(C.orders(Arriving), out, f"{out}/checkpoint")
    daily = C.as_doubles(I.refreshed_daily(t.spark, out))
    return daily.select("order_date", "order_count", "unique_customers", "daily_revenue", "cumulative_revenue")


@query("st_windowed_counts", """
WITH seen AS (SELECT DISTINCT ON (event_id) event_id, event_type, CAST(ts AS TIMESTAMP) AS ts, value FROM events),
w AS (SELECT DATE_TRUNC('hour', ts) AS window_start, event_type, COUNT(*) AS events, ROUND(SUM(value), 2) AS amount FROM seen GROUP BY ALL)
SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT DATE_TRUNC('millisecond', MAX(ts)) FROM seen) - INTERVAL 10 MINUTE
""")
def st_windowed_counts(t):
    """Windows that the watermark has passed: those ending ten minutes or more before the
    last event. Later ones stay open until further events arrive."""
    out = scratch_path(t.spark, "windows")
    stream = arriving(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    I.append_files(I.windowed_counts(stream, "ts", "event_id", "event_type", "value"), f"{out}/rows", f"{out}/checkpoint")
    rows = t.spark.read.schema("window_start timestamp, event_type string, events long, amount double").parquet(f"{out}/rows")
    return rows.withColumn("amount", F.round("amount", 2))
