"""Window functions. Windows over the whole table at row grain go through
`operators.ordered`; only results already grouped to days or months (a few
thousand rows at any data size) use a plain unpartitioned window."""

from pyspark.sql import Window, functions as F

from quayside.functions import numbers as N
from quayside.functions.exact import exact_sum, line_total, round_half_up
from quayside.operators import ordered as O, series as S
from quayside.queries.registry import query
from quayside.session import materialise
from quayside.queries.sqltext import LINE_TOTAL, half_up, money, total


def on(a, b):
    return F.col(a) == F.col(b)


def delivered(t):
    return t.orders.filter(F.col("o_orderstatus") == "F")


def monthly(t):
    """Delivered revenue per month, as an exact decimal."""
    return delivered(t).groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue")
    )


def daily(t):
    return delivered(t).groupBy(F.col("o_orderdate").cast("date").alias("order_date")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("daily_revenue")
    )


def spend(t):
    """Delivered spend per customer, summed before the join with the customer.

    Written once, as the ordered windows read their input several times."""
    per = delivered(t).groupBy("o_custkey").agg(
        exact_sum("o_totalprice").alias("total_spent"), F.count(F.lit(1)).alias("order_count")
    )
    rows = per.join(t.customer, on("o_custkey", "c_custkey")).select(
        "c_custkey", "c_name", "c_nationkey", "total_spent", "order_count"
    )
    return materialise(rows, "spend")


MONTHLY = f"""SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, SUM({money('o_totalprice')}) AS revenue
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"""
DAILY = f"""SELECT CAST(o_orderdate AS DATE) AS order_date, SUM({money('o_totalprice')}) AS daily_revenue
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"""
SPEND = f"""SELECT c_custkey, c_name, c_nationkey, {total('o_totalprice')} AS total_spent, COUNT(o_orderkey) AS order_count
  FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY ALL"""


@query("w_mom_growth", f"""
WITH m AS ({MONTHLY}), l AS (SELECT *, LAG(revenue) OVER (ORDER BY month) AS prev FROM m)
SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_month_revenue,
       CAST(revenue - prev AS DOUBLE) AS revenue_change,
       {half_up('CAST(revenue - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100')} AS growth_percentage
FROM l
""")
def w_mom_growth(t):
    """Month-over-month growth: one row per month reaches the window."""
    out = monthly(t).withColumn("prev", F.lag("revenue").over(Window.orderBy("month")))
    change = (F.col("revenue") - F.col("prev")).cast("double")
    return out.select(
        "month", F.col("revenue").cast("double").alias("revenue"),
        F.col("prev").cast("double").alias("prev_month_revenue"), change.alias("revenue_change"),
        round_half_up(F.try_divide(change, F.col("prev").cast("double")) * 100).alias("growth_percentage"),
    )


@query("w_lead", f"""
WITH m AS ({MONTHLY})
SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(LEAD(revenue) OVER (ORDER BY month) AS DOUBLE) AS next_month_revenue
FROM m
""")
def w_lead(t):
    nxt = F.lead("revenue").over(Window.orderBy("month")).cast("double")
    return monthly(t).select("month", F.col("revenue").cast("double").alias("revenue"), nxt.alias("next_month_revenue"))


@query("w_first_value", """
SELECT c_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
       FIRST_VALUE(o_totalprice) OVER w AS first_order_amount,
       o_totalprice - FIRST_VALUE(o_totalprice) OVER w AS amount_vs_first_order
FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F'
WINDOW w AS (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey)
""")
def w_first_value(t):
    """FIRST_VALUE as MIN_BY per customer: it combines before the shuffle."""
    first = F.min_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("first_order_amount")
    rows = O.back_to_rows(delivered(t), ["o_custkey"], first)
    return rows.join(t.customer, on("o_custkey", "c_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice",
        "first_order_amount", (F.col("o_totalprice") - F.col("first_order_amount")).alias("amount_vs_first_order"),
    )


@query("w_last_value", """
SELECT o_custkey, o_orderkey, o_totalprice,
       LAST_VALUE(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order_amount
FROM orders WHERE o_orderstatus = 'F'
""")
def w_last_value(t):
    last = F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_order_amount")
    return O.back_to_rows(delivered(t), ["o_custkey"], last).select(
        "o_custkey", "o_orderkey", "o_totalprice", "last_order_amount"
    )


@query("w_ntile_segments", f"""
WITH s AS ({SPEND}), q AS (SELECT *, NTILE(4) OVER (ORDER BY total_spent DESC, c_custkey) AS spend_quartile FROM s)
SELECT c_custkey, c_name, total_spent, order_count, spend_quartile,
       CASE spend_quartile WHEN 1 THEN 'VIP' WHEN 2 THEN 'High Value' WHEN 3 THEN 'Medium Value' ELSE 'Low Value' END AS customer_segment
FROM q
""")
def w_ntile_segments(t):
    out = O.with_ntile(spend(t), 4, ["-total_spent", "c_custkey"], name="spend_quartile")
    q = F.col("spend_quartile")
    label = F.when(q == 1, "VIP").when(q == 2, "High Value").when(q == 3, "Medium Value").otherwise("Low Value")
    return out.select("c_custkey", "c_name", "total_spent", "order_count", "spend_quartile", label.alias("customer_segment"))


@query("w_percent_rank", f"""
WITH s AS ({SPEND}), p AS (SELECT *, PERCENT_RANK() OVER (ORDER BY total_spent DESC) AS percentile_rank FROM s)
SELECT c_custkey, c_name, total_spent, percentile_rank,
       CASE WHEN percentile_rank <= 0.10 THEN 'Top 10%' WHEN percentile_rank <= 0.25 THEN 'Top 25%'
            WHEN percentile_rank <= 0.50 THEN 'Top 50%' ELSE 'Bottom 50%' END AS revenue_tier
FROM p
""")
def w_percent_rank(t):
    out = O.with_rank(spend(t), "-total_spent", percent="percentile_rank")
    p = F.col("percentile_rank")
    tier = F.when(p <= 0.10, "Top 10%").when(p <= 0.25, "Top 25%").when(p <= 0.50, "Top 50%").otherwise("Bottom 50%")
    return out.select("c_custkey", "c_name", "total_spent", "percentile_rank", tier.alias("revenue_tier"))


@query("w_rank_compare", f"""
WITH s AS (SELECT p_partkey, p_name, SUM(CAST(l_quantity AS BIGINT)) AS units_sold, CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS revenue
  FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderstatus = 'F' GROUP BY p_partkey, p_name)
SELECT p_partkey, p_name, CAST(units_sold AS BIGINT) AS units_sold, revenue,
       ROW_NUMBER() OVER (ORDER BY units_sold DESC, p_partkey) AS row_num,
       RANK() OVER (ORDER BY units_sold DESC) AS rank, DENSE_RANK() OVER (ORDER BY units_sold DESC) AS dense_rank
FROM s
""")
def w_rank_compare(t):
    """Ranked by units sold, where ties are common."""
    rows = materialise(part_sales(t).withColumn("revenue", F.col("revenue").cast("double")), "units-sold")
    out = O.with_position(rows, ["-units_sold", "p_partkey"], name="row_num")
    return O.with_rank(out, "-units_sold", rank="rank", dense="dense_rank")


@query("w_rank_revenue", f"""
WITH s AS (SELECT p_partkey, p_name, SUM(CAST(l_quantity AS BIGINT)) AS units_sold, SUM({LINE_TOTAL}) AS revenue
  FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderstatus = 'F' GROUP BY p_partkey, p_name)
SELECT p_partkey, p_name, CAST(units_sold AS BIGINT) AS units_sold, CAST(revenue AS DOUBLE) AS revenue,
       ROW_NUMBER() OVER (ORDER BY revenue DESC, p_partkey) AS row_num,
       RANK() OVER (ORDER BY revenue DESC) AS rank, DENSE_RANK() OVER (ORDER BY revenue DESC) AS dense_rank
FROM s
""")
def w_rank_revenue(t):
    """Ranked by revenue, summed and compared as decimals."""
    rows = materialise(part_sales(t), "part-revenue")
    out = O.with_position(rows, ["-revenue", "p_partkey"], name="row_num")
    return O.with_rank(out, "-revenue", rank="rank", dense="dense_rank").withColumn("revenue", F.col("revenue").cast("double"))


def part_sales(t):
    """Units and revenue of the delivered lines of each part."""
    sold = t.lineitem.join(delivered(t).select("o_orderkey"), on("l_orderkey", "o_orderkey"), "left_semi")
    per = sold.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("units_sold"), F.sum(line_total()).alias("revenue")
    )
    return per.join(t.part, on("l_partkey", "p_partkey")).select("p_partkey", "p_name", "units_sold", "revenue")


@query("w_running_total", f"""
WITH d AS ({DAILY})
SELECT order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue,
       CAST(SUM(daily_revenue) OVER (ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_revenue
FROM d
""")
def w_running_total(t):
    w = Window.orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily(t).select(
        "order_date", F.col("daily_revenue").cast("double").alias("daily_revenue"),
        F.sum("daily_revenue").over(w).cast("double").alias("cumulative_revenue"),
    )


@query("w_moving_avg", f"""
WITH d AS ({DAILY}), m AS (
  SELECT *, CAST(SUM(daily_revenue) OVER a AS DOUBLE) / COUNT(*) OVER a AS m7, CAST(SUM(daily_revenue) OVER b AS DOUBLE) / COUNT(*) OVER b AS m30
  FROM d WINDOW a AS (ORDER BY order_date ROWS 6 PRECEDING), b AS (ORDER BY order_date ROWS 29 PRECEDING))
SELECT order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, m7 AS moving_avg_7day, m30 AS moving_avg_30day,
       CAST(daily_revenue AS DOUBLE) - m7 AS deviation_from_avg
FROM m
""")
def w_moving_avg(t):
    out = S.moving_averages(materialise(daily(t), "daily"), "order_date", "daily_revenue", {"moving_avg_7day": 7, "moving_avg_30day": 30})
    day = F.col("daily_revenue").cast("double")
    return out.select(
        "order_date", day.alias("daily_revenue"), "moving_avg_7day", "moving_avg_30day",
        (day - F.col("moving_avg_7day")).alias("deviation_from_avg"),
    )


@query("w_range_cumulative", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(SUM({money('o_totalprice')}) OVER (ORDER BY CAST(o_orderdate AS DATE)) AS DOUBLE) AS cumulative_revenue
FROM orders WHERE o_orderstatus = 'F'
""")
def w_range_cumulative(t):
    rows = delivered(t).select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice")
    out = O.with_range_running(rows, "order_date", {"s": F.col("o_totalprice").cast("decimal(18,2)")})
    return out.select("o_orderkey", "order_date", F.col("s").cast("double").alias("cumulative_revenue"))


@query("w_city_avg", f"""
SELECT n_name AS city, o_orderkey, o_totalprice,
       CAST(SUM({money('o_totalprice')}) OVER (PARTITION BY n_name) AS DOUBLE) / COUNT(*) OVER (PARTITION BY n_name) AS city_avg
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F'
""")
def w_city_avg(t):
    """The averages come from sums per customer; the rows then join a table of cities."""
    per = delivered(t).groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    people = t.customer.join(t.nation, on("c_nationkey", "n_nationkey")).select("c_custkey", F.col("n_name").alias("city"))
    averages = per.join(people, on("o_custkey", "c_custkey")).groupBy(F.col("city").alias("_city")).agg(
        (F.sum("s").cast("double") / F.sum("n")).alias("city_avg")
    )
    return delivered(t).join(people, on("o_custkey", "c_custkey")).join(averages, on("city", "_city")).select(
        "city", "o_orderkey", "o_totalprice", "city_avg"
    )


@query("w_spend_rank", f"""
WITH s AS ({SPEND})
SELECT c_custkey, c_name, total_spent, RANK() OVER (ORDER BY total_spent DESC) AS spend_rank FROM s
""")
def w_spend_rank(t):
    return O.with_rank(spend(t), "-total_spent", rank="spend_rank").select("c_custkey", "c_name", "total_spent", "spend_rank")


@query("w_category_rank", """
SELECT p_partkey, p_brand, p_size, RANK() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS category_rank FROM part
""")
def w_category_rank(t):
    rows = t.part.select("p_partkey", "p_brand", "p_size")
    return O.with_rank(rows, "-p_size", ["p_brand"], rank="category_rank")


@query("w_daily_revenue", f"""
SELECT order_date, order_count, unique_customers, CAST(rev AS DOUBLE) AS daily_revenue,
       CAST(rev AS DOUBLE) / order_count AS avg_order_value,
       CAST(SUM(rev) OVER (ORDER BY order_date ROWS 6 PRECEDING) AS DOUBLE) / COUNT(*) OVER (ORDER BY order_date ROWS 6 PRECEDING) AS moving_avg_7day,
       CAST(SUM(rev) OVER (ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_revenue
FROM (SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(DISTINCT o_orderkey) AS order_count,
        COUNT(DISTINCT o_custkey) AS unique_customers, SUM({money('o_totalprice')}) AS rev
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
""")
def w_daily_revenue(t):
    from quayside.plans.marts import daily_revenue
    from quayside.queries.commerce import orders

    return daily_revenue(orders(t)).select(
        "order_date", "order_count", "unique_customers", F.col("daily_revenue").cast("double").alias("daily_revenue"),
        "avg_order_value", "moving_avg_7day", F.col("cumulative_revenue").cast("double").alias("cumulative_revenue"),
    )


@query("w_topk_rank", f"""
WITH s AS ({SPEND}), r AS (SELECT *, RANK() OVER (ORDER BY total_spent DESC) AS rank FROM s)
SELECT c_custkey, c_name, total_spent, rank FROM r WHERE rank <= 10
""")
def w_topk_rank(t):
    return O.top_with_ties(spend(t), "total_spent", 10).select("c_custkey", "c_name", "total_spent", "rank")


@query("w_lag_features", """
SELECT event_id, user_id, ts, value, LAG(value, 1) OVER w AS prev_value, LAG(value, 2) OVER w AS prev_2_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def w_lag_features(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    cols = lambda w: {"prev_value": F.lag("value", 1).over(w), "prev_2_value": F.lag("value", 2).over(w)}
    return O.with_neighbours(rows, ["ts", "event_id"], cols, ["user_id"], before=2)


@query("w_rolling3", """
SELECT event_id, user_id, ROUND(AVG(value) OVER w, 6) AS rolling_avg_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)
""")
def w_rolling3(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = S.moving_average(rows, ["ts", "event_id"], "value", 3, "rolling_avg_3", keys=["user_id"])
    return out.select("event_id", "user_id", F.round("rolling_avg_3", 6).alias("rolling_avg_3"))


@query("w_days_since", """
SELECT event_id, user_id, CAST(FLOOR((EPOCH_US(ts) - EPOCH_US(LAG(ts) OVER w)) / 86400000000) AS BIGINT) AS days_since_last
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def w_days_since(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return S.lag_features(rows, ["user_id"], "ts", ["ts", "event_id"], "value").select(
        "event_id", "user_id", "days_since_last"
    )


@query("w_full_moving_avg", f"""
WITH d AS ({DAILY}), m AS (SELECT order_date, CAST(SUM(daily_revenue) OVER w AS DOUBLE) / 5 AS moving_avg, COUNT(*) OVER w AS n
  FROM d WINDOW w AS (ORDER BY order_date ROWS 4 PRECEDING))
SELECT order_date, moving_avg FROM m WHERE n = 5
""")
def w_full_moving_avg(t):
    out = S.moving_average(materialise(daily(t), "daily"), "order_date", "daily_revenue", 5, "moving_avg", full_only=True)
    return out.select("order_date", "moving_avg")


@query("w_growth_rate", f"""
WITH m AS ({MONTHLY}), l AS (SELECT month, CAST(revenue AS DOUBLE) AS new, CAST(LAG(revenue, 1, 0) OVER (ORDER BY month) AS DOUBLE) AS old FROM m)
SELECT month, CASE WHEN old = 0 AND new = 0 THEN 0.0 WHEN old = 0 THEN CAST('inf' AS DOUBLE) ELSE (new - old) / old * 100 END AS growth_rate
FROM l
""")
def w_growth_rate(t):
    prev = F.lag("revenue", 1, 0).over(Window.orderBy("month"))
    out = monthly(t).withColumn("old", prev)
    return out.select("month", N.growth_rate("old", "revenue").alias("growth_rate"))


# Readings of failed events count as unknown: the gaps to fill.
GAPS = "SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN value END AS v FROM events"


def gaps(t):
    known = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", "ts", known.alias("v"))


@query("w_ffill_bfill", f"""
WITH e AS ({GAPS})
SELECT event_id, v, LAST_VALUE(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v_ffill,
       FIRST_VALUE(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v_bfill
FROM e
""")
def w_ffill_bfill(t):
    return S.ffill_bfill(gaps(t), ["ts", "event_id"], ["v"]).select("event_id", "v", "v_ffill", "v_bfill")


@query("w_interp_linear", f"""
WITH e AS ({GAPS}), n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS rn FROM e),
k AS (SELECT *, CASE WHEN v IS NOT NULL THEN rn END AS kn FROM n),
p AS (SELECT *, LAST_VALUE(kn IGNORE NULLS) OVER a AS pn, LAST_VALUE(v IGNORE NULLS) OVER a AS pv,
        FIRST_VALUE(kn IGNORE NULLS) OVER b AS nn, FIRST_VALUE(v IGNORE NULLS) OVER b AS nv
      FROM k WINDOW a AS (ORDER BY rn ROWS UNBOUNDED PRECEDING), b AS (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
       ELSE pv + (nv - pv) / CAST(nn - pn AS DOUBLE) * (rn - pn) END AS v_linear
FROM p
""")
def w_interp_linear(t):
    return S.interpolate_linear(gaps(t), ["ts", "event_id"], "v", "v_linear").select("event_id", "v_linear")


@query("w_interp_quadratic", f"""
WITH e AS ({GAPS}), n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS rn FROM e),
k AS (SELECT rn, v, LAG(rn) OVER w AS brn, LAG(v) OVER w AS bv, LEAD(rn) OVER w AS arn, LEAD(v) OVER w AS av FROM n WHERE v IS NOT NULL WINDOW w AS (ORDER BY rn)),
p AS (SELECT *, LAST_VALUE(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS UNBOUNDED PRECEDING) AS ln,
  FIRST_VALUE(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hn FROM n),
t AS (SELECT p.event_id, p.v, CAST(p.rn AS DOUBLE) AS x, l.rn AS x1, l.v AS y1, h.rn AS x2, h.v AS y2,
  CASE WHEN l.brn IS NOT NULL AND (h.arn IS NULL OR p.rn - l.brn <= h.arn - p.rn) THEN l.brn ELSE h.arn END AS x3,
  CASE WHEN l.brn IS NOT NULL AND (h.arn IS NULL OR p.rn - l.brn <= h.arn - p.rn) THEN l.bv ELSE h.av END AS y3
  FROM p LEFT JOIN k l ON p.ln = l.rn LEFT JOIN k h ON p.hn = h.rn)
SELECT event_id, ROUND(CASE WHEN v IS NOT NULL THEN v ELSE y1 * (x - x2) * (x - x3) / ((x1 - x2) * (x1 - x3))
  + y2 * (x - x1) * (x - x3) / ((x2 - x1) * (x2 - x3)) + y3 * (x - x1) * (x - x2) / ((x3 - x1) * (x3 - x2)) END, 6) AS v_quadratic FROM t
""")
def w_interp_quadratic(t):
    out = S.interpolate_quadratic(gaps(t), ["ts", "event_id"], "v", "v_quadratic")
    return out.select("event_id", F.round("v_quadratic", 6).alias("v_quadratic"))
