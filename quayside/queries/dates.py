"""Date functions."""

from pyspark.sql import functions as F

from quayside.functions import dates as D
from quayside.queries.registry import query
from quayside.queries.sqltext import AS_OF, age_months


def as_of():
    return F.lit("2001-08-01").cast("date")


@query("f_month_trunc", """
SELECT o_orderkey, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month FROM orders
""")
def f_month_trunc(t):
    return t.orders.select("o_orderkey", D.month_start("o_orderdate").alias("month"))


@query("f_date_parts", """
SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate) AS order_year, EXTRACT(QUARTER FROM o_orderdate) AS order_quarter,
       EXTRACT(MONTH FROM o_orderdate) AS order_month, EXTRACT(DOW FROM o_orderdate) AS order_day_of_week FROM orders
""")
def f_date_parts(t):
    parts = D.date_parts("o_orderdate", "order_")
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("f_date_features", """
SELECT o_orderkey, YEAR(o_orderdate) AS purchase_year, MONTH(o_orderdate) AS purchase_month, DAY(o_orderdate) AS purchase_day,
       ISODOW(o_orderdate) - 1 AS purchase_weekday, QUARTER(o_orderdate) AS purchase_quarter,
       WEEKOFYEAR(o_orderdate) AS purchase_week_of_year,
       CASE WHEN ISODOW(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN DAY(o_orderdate) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN CAST(o_orderdate AS DATE) = LAST_DAY(o_orderdate) THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN MONTH(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN MONTH(o_orderdate) IN (3, 4, 5) THEN 'Summer'
            WHEN MONTH(o_orderdate) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END AS season
FROM orders
""")
def f_date_features(t):
    cols = D.calendar_features("o_orderdate")
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in cols.items()])


@query("f_season", """
SELECT CASE WHEN MONTH(l_shipdate) IN (12, 1, 2) THEN 'Winter' WHEN MONTH(l_shipdate) IN (3, 4, 5) THEN 'Summer'
            WHEN MONTH(l_shipdate) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END AS season, COUNT(*) AS lines
FROM lineitem GROUP BY 1
""")
def f_season(t):
    return t.lineitem.groupBy(D.season("l_shipdate").alias("season")).agg(F.count(F.lit(1)).alias("lines"))


@query("f_day_name", "SELECT o_orderkey, DAYNAME(o_orderdate) AS day_name, DAY(o_orderdate) AS day FROM orders")
def f_day_name(t):
    return t.orders.select(
        "o_orderkey", D.day_name("o_orderdate").alias("day_name"), F.dayofmonth("o_orderdate").cast("bigint").alias("day")
    )


@query("f_age_years", f"""
SELECT o_orderkey, CAST(FLOOR({age_months(AS_OF, 'o_orderdate')} / 12) AS BIGINT) AS age_years,
       CAST({age_months(AS_OF, 'o_orderdate')} % 12 AS BIGINT) AS age_month_part,
       CAST({age_months(AS_OF, 'o_orderdate')} AS BIGINT) AS age_months FROM orders
""")
def f_age_years(t):
    return t.orders.select(
        "o_orderkey", D.age_years(as_of(), "o_orderdate").alias("age_years"),
        D.age_month_part(as_of(), "o_orderdate").alias("age_month_part"),
        D.age_months(as_of(), "o_orderdate").alias("age_months"),
    )


@query("f_recency_days", f"""
SELECT o_orderkey, DATE_DIFF('day', CAST(o_orderdate AS DATE), {AS_OF}) AS days_since
FROM orders WHERE o_orderdate >= {AS_OF} - INTERVAL 90 DAY
""")
def f_recency_days(t):
    recent = F.col("o_orderdate") >= F.date_sub(as_of(), 90).cast("timestamp_ntz")
    return t.orders.filter(recent).select("o_orderkey", D.days_since("o_orderdate", as_of()).alias("days_since"))


# Dates written in five ways by priority; LOW priority ones are unreadable.
WRITTEN = """CASE o_orderpriority WHEN '1-URGENT' THEN STRFTIME(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN STRFTIME(o_orderdate, '%d/%m/%Y') WHEN '3-MEDIUM' THEN STRFTIME(o_orderdate, '%Y.%m.%d')
  WHEN '4-NOT SPECIFIED' THEN STRFTIME(o_orderdate, '%b %d, %Y') ELSE 'day ' || STRFTIME(o_orderdate, '%j') END"""


def written():
    c, p = F.col("o_orderdate"), F.col("o_orderpriority")
    fmt = lambda f: F.date_format(c, f)
    return (
        F.when(p == "1-URGENT", fmt("yyyy-MM-dd")).when(p == "2-HIGH", fmt("dd/MM/yyyy"))
        .when(p == "3-MEDIUM", fmt("yyyy.MM.dd")).when(p == "4-NOT SPECIFIED", fmt("MMM dd, yyyy"))
        .otherwise(F.concat(F.lit("day "), fmt("DDD")))
    )


@query("f_parse_dates", f"""
WITH w AS (SELECT o_orderkey, {WRITTEN} AS written FROM orders)
SELECT o_orderkey, written, CAST(COALESCE(TRY_STRPTIME(written, '%Y-%m-%d'), TRY_STRPTIME(written, '%d/%m/%Y'),
  TRY_STRPTIME(written, '%Y.%m.%d'), TRY_STRPTIME(written, '%b %d, %Y')) AS DATE) AS parsed FROM w
""")
def f_parse_dates(t):
    return t.orders.select("o_orderkey", written().alias("written")).withColumn("parsed", D.parse_date("written"))


@query("f_valid_date", f"""
WITH w AS (SELECT o_orderkey, {WRITTEN} AS written FROM orders)
SELECT o_orderkey, TRY_STRPTIME(written, '%Y-%m-%d') IS NOT NULL AS is_valid FROM w
""")
def f_valid_date(t):
    return t.orders.select("o_orderkey", D.is_valid_date(written()).alias("is_valid"))


@query("f_format_date", """
SELECT o_orderkey, STRFTIME(o_orderdate, '%Y-%m-%d') AS iso, STRFTIME(o_orderdate, '%d/%m/%Y') AS shown FROM orders
""")
def f_format_date(t):
    return t.orders.select(
        "o_orderkey", D.format_date("o_orderdate").alias("iso"), D.format_date("o_orderdate", "dd/MM/yyyy").alias("shown")
    )


@query("f_format_duration", """
SELECT event_id, CASE WHEN value * 60 < 60 THEN FORMAT('{:.2f} seconds', value * 60)
  WHEN value * 60 < 3600 THEN FORMAT('{:.2f} minutes', value * 60 / 60) ELSE FORMAT('{:.2f} hours', value * 60 / 3600) END AS shown
FROM events
""")
def f_format_duration(t):
    return t.events.select("event_id", D.format_duration(F.col("value") * 60).alias("shown"))
