"""Marts, cohorts, scoring and saved results."""

from pyspark.sql import functions as F

from quayside.plans import marts as M
from quayside.queries import commerce as C
from quayside.queries.registry import query
from quayside.queries.sqltext import AS_OF, LINE_TOTAL, age_months, half_up, money, total
from quayside.session import scratch_path

TIERS = ((925, 950, 975), ("Budget", "Mid-Range", "Premium", "Luxury"))
COST = "CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,3))"
PRICE = "CAST(p_retailprice AS DECIMAL(10,2))"
QTY = "CAST(l_quantity AS INTEGER)"

FACT = f"""fact AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id, CAST(o_orderdate AS DATE) AS order_date,
  o_orderpriority AS payment_method, {QTY} AS quantity, l_extendedprice / l_quantity AS unit_price, l_discount * 100 AS discount_percent,
  {LINE_TOTAL} AS line_total, {COST} AS unit_cost, {QTY} * {COST} AS line_cost, {LINE_TOTAL} - {QTY} * {COST} AS line_profit
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F')"""
REG = "reg AS (SELECT o_custkey AS rk, CAST(MIN(o_orderdate) AS DATE) AS registration_date FROM orders GROUP BY o_custkey)"


def as_of():
    return F.lit("2001-08-01").cast("date")


def fact(t):
    return M.fact_orders(C.orders(t), C.order_items(t), C.products(t))


@query("t_fact_orders", f"""
WITH {FACT} SELECT order_id, customer_id, product_id, order_date, YEAR(order_date) AS order_year, QUARTER(order_date) AS order_quarter,
  MONTH(order_date) AS order_month, DAYOFWEEK(order_date) AS order_day_of_week, 'F' AS order_status, payment_method, quantity,
  unit_price, discount_percent, CAST(line_total AS DOUBLE) AS line_total, CAST(unit_cost AS DOUBLE) AS unit_cost,
  CAST(line_cost AS DOUBLE) AS line_cost, CAST(line_profit AS DOUBLE) AS line_profit FROM fact
""")
def t_fact_orders(t):
    return C.as_doubles(fact(t))


@query("t_dim_customers", f"""
WITH {REG} SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city, r_name AS state, c_mktsegment AS customer_segment,
  registration_date, YEAR(registration_date) AS registration_year,
  CAST(FLOOR({age_months(AS_OF, 'registration_date')} / 12) AS BIGINT) AS customer_age_years
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN reg ON rk = c_custkey
""")
def t_dim_customers(t):
    return M.dim_customers(C.customers(t), as_of())


@query("t_dim_products", f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category_name, CAST({PRICE} AS DOUBLE) AS price, CAST({COST} AS DOUBLE) AS cost,
  CAST({PRICE} - {COST} AS DOUBLE) AS profit_per_unit, {half_up(f'CAST({PRICE} - {COST} AS DOUBLE) / CAST({PRICE} AS DOUBLE) * 100')} AS profit_margin_pct,
  CASE WHEN p_retailprice < 925 THEN 'Budget' WHEN p_retailprice < 950 THEN 'Mid-Range' WHEN p_retailprice < 975 THEN 'Premium' ELSE 'Luxury' END AS price_tier
FROM part
""")
def t_dim_products(t):
    return C.as_doubles(M.dim_products(C.products(t), TIERS))


@query("t_revenue_month_category", f"""
WITH {FACT} SELECT YEAR(order_date) AS order_year, MONTH(order_date) AS order_month, p_brand AS category_name, COUNT(DISTINCT order_id) AS order_count,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(line_total) AS DOUBLE) AS revenue, CAST(SUM(line_profit) AS DOUBLE) AS profit,
  {half_up('CAST(SUM(line_total) AS DOUBLE) / COUNT(*)')} AS avg_order_line_value
FROM fact JOIN part ON product_id = p_partkey GROUP BY ALL
""")
def t_revenue_month_category(t):
    lines = M.fact_orders(C.orders(t), C.order_items(t), C.products(t), "category_name")
    return C.as_doubles(M.revenue_by_month_category(lines, C.products(t)))


@query("t_cohort_mart", f"""
WITH {FACT}, {REG}, c AS (SELECT customer_id, CAST(DATE_TRUNC('month', registration_date) AS DATE) AS cohort_month,
  CAST(DATE_TRUNC('month', order_date) AS DATE) AS order_month, line_total FROM fact JOIN reg ON rk = customer_id)
SELECT cohort_month, order_month, COUNT(DISTINCT customer_id) AS active_customers, CAST(SUM(line_total) AS DOUBLE) AS revenue,
  CAST({age_months('order_month', 'cohort_month')} % 12 AS BIGINT) AS months_since_cohort FROM c GROUP BY cohort_month, order_month
""")
def t_cohort_mart(t):
    return C.as_doubles(M.cohort_activity(fact(t), C.registrations(t)))


@query("t_affinity", f"""
WITH {FACT}, d AS (SELECT DISTINCT order_id, product_id FROM fact),
p AS (SELECT a.product_id AS item_a, b.product_id AS item_b, COUNT(*) AS n FROM d a JOIN d b ON a.order_id = b.order_id AND a.product_id < b.product_id
  GROUP BY 1, 2 HAVING COUNT(*) >= 3),
r AS (SELECT *, RANK() OVER (PARTITION BY item_a ORDER BY n DESC) AS affinity_rank FROM p ORDER BY n DESC, item_a, item_b LIMIT 20)
SELECT item_a, item_b, x.p_name AS product_a_name, y.p_name AS product_b_name, n AS co_occurrence_count, affinity_rank
FROM r JOIN part x ON item_a = x.p_partkey JOIN part y ON item_b = y.p_partkey
""")
def t_affinity(t):
    return M.affinity(fact(t), C.products(t))


@query("t_cohort_retention", f"""
WITH {REG}, co AS (SELECT rk AS customer_id, CAST(DATE_TRUNC('month', registration_date) AS DATE) AS cohort_month FROM reg),
o AS (SELECT customer_id, cohort_month, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS order_month, {money('o_totalprice')} AS amount
  FROM co JOIN orders ON customer_id = o_custkey WHERE o_orderstatus = 'F'),
m AS (SELECT cohort_month, order_month, COUNT(DISTINCT customer_id) AS active_customers, SUM(amount) AS revenue FROM o GROUP BY 1, 2),
z AS (SELECT cohort_month, COUNT(DISTINCT customer_id) AS cohort_size FROM co GROUP BY 1)
SELECT m.cohort_month, CAST({age_months('order_month', 'm.cohort_month')} AS BIGINT) AS months_since_cohort, active_customers, cohort_size,
  {half_up('CAST(active_customers AS DOUBLE) / cohort_size * 100')} AS retention_rate, CAST(revenue AS DOUBLE) AS revenue,
  {half_up('CAST(revenue AS DOUBLE) / active_customers')} AS revenue_per_customer
FROM m JOIN z ON m.cohort_month = z.cohort_month
""")
def t_cohort_retention(t):
    return C.as_doubles(M.cohort_retention(C.registrations(t), C.orders(t)))


RECENCY = "CASE WHEN days <= 30 THEN 5 WHEN days <= 60 THEN 4 WHEN days <= 90 THEN 3 WHEN days <= 180 THEN 2 ELSE 1 END"
FREQUENCY = "CASE WHEN n >= 10 THEN 5 WHEN n >= 7 THEN 4 WHEN n >= 5 THEN 3 WHEN n >= 3 THEN 2 ELSE 1 END"


@query("t_rfm_clv", f"""
WITH g AS (SELECT c_custkey, c_name, c_mktsegment, COUNT(o_orderkey) AS n, SUM({money('o_totalprice')}) AS rev, CAST(MAX(o_orderdate) AS DATE) AS last_d,
    CAST(MIN(o_orderdate) AS DATE) AS first_d FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY ALL),
d AS (SELECT *, DATE_DIFF('day', last_d, {AS_OF}) AS days, {age_months('last_d', 'first_d')} % 12 AS months FROM g),
s AS (SELECT *, {RECENCY} AS r, {FREQUENCY} AS f, NTILE(5) OVER (ORDER BY rev DESC NULLS FIRST, c_custkey) AS m FROM d)
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment, n AS total_orders, CAST(rev AS DOUBLE) AS total_revenue,
  {half_up('CAST(rev AS DOUBLE) / n')} AS avg_order_value, days AS days_since_last_order,
  {half_up('CAST(rev AS DOUBLE) * (1 + FLOOR(CAST(n AS DOUBLE) / NULLIF(months, 0)))')} AS estimated_clv,
  r AS recency_score, f AS frequency_score, m AS monetary_score, r + f + m AS rfm_score,
  CASE WHEN r + f + m >= 13 THEN 'Champions' WHEN r + f + m >= 10 THEN 'Loyal' WHEN r + f + m >= 7 THEN 'Potential' ELSE 'At Risk' END AS customer_category
FROM s
""")
def t_rfm_clv(t):
    return M.rfm(C.customers(t), C.orders(t), as_of())


@query("t_customer_summary", f"""
WITH {REG}, g AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, COUNT(DISTINCT o_orderkey) AS n, SUM({money('o_totalprice')}) AS rev,
    CAST(MAX(o_orderdate) AS DATE) AS last_d, CAST(MIN(o_orderdate) AS DATE) AS first_d
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY ALL),
d AS (SELECT *, DATE_DIFF('day', last_d, {AS_OF}) AS days FROM g)
SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city, r_name AS state, c_mktsegment AS customer_segment, registration_date,
  n AS total_orders, CAST(rev AS DOUBLE) AS total_revenue, CAST(rev AS DOUBLE) / NULLIF(n, 0) AS avg_order_value, last_d AS last_order_date,
  first_d AS first_order_date, days AS days_since_last_order, {RECENCY} AS recency_score, {FREQUENCY} AS frequency_score,
  NTILE(5) OVER (ORDER BY rev DESC NULLS FIRST, c_custkey) AS monetary_score
FROM d JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN reg ON rk = c_custkey
""")
def t_customer_summary(t):
    return C.as_doubles(M.customer_summary(C.customers(t), C.orders(t), as_of()))


PERFORMANCE = f"""pp AS (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category_name, {PRICE} AS price, {COST} AS cost,
  COUNT(DISTINCT l_orderkey) AS total_orders, CAST(SUM({QTY}) AS BIGINT) AS units_sold, SUM({LINE_TOTAL}) AS total_revenue,
  CAST(SUM(CAST(l_discount * 100 AS DECIMAL(7,2))) AS DOUBLE) / NULLIF(COUNT(l_discount), 0) AS avg_discount_pct
  FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL)"""


@query("t_product_performance", f"""
WITH {PERFORMANCE} SELECT product_id, product_name, category_name, CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost, total_orders, units_sold,
  CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(price - cost AS DOUBLE) AS profit_per_unit,
  {half_up('CAST(price - cost AS DOUBLE) / CAST(price AS DOUBLE) * 100')} AS profit_margin_pct, CAST(units_sold * cost AS DOUBLE) AS total_cost,
  avg_discount_pct, CAST(total_revenue - units_sold * cost AS DOUBLE) AS total_profit,
  RANK() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank,
  RANK() OVER (PARTITION BY category_name ORDER BY total_revenue DESC NULLS FIRST) AS category_rank FROM pp
""")
def t_product_performance(t):
    return C.as_doubles(M.product_performance(C.products(t), C.order_items(t)))


@query("t_top_products", f"""
WITH {PERFORMANCE} SELECT product_id, product_name, category_name, CAST(total_revenue - units_sold * cost AS DOUBLE) AS total_profit FROM pp
ORDER BY total_profit DESC NULLS LAST, product_id LIMIT 10
""")
def t_top_products(t):
    out = M.product_sales(C.products(t), C.order_items(t)).select(
        "product_id", "product_name", "category_name", F.col("total_profit").cast("double").alias("total_profit")
    )
    return out.orderBy(F.col("total_profit").desc_nulls_last(), "product_id").limit(10)


@query("t_daily_revenue", f"""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(DISTINCT o_orderkey) AS order_count, COUNT(DISTINCT o_custkey) AS unique_customers,
  SUM({money('o_totalprice')}) AS rev FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT order_date, order_count, unique_customers, CAST(rev AS DOUBLE) AS daily_revenue, CAST(rev AS DOUBLE) / order_count AS avg_order_value,
  CAST(SUM(rev) OVER a AS DOUBLE) / COUNT(*) OVER a AS moving_avg_7day, CAST(SUM(rev) OVER b AS DOUBLE) / COUNT(*) OVER b AS moving_avg_30day,
  CAST(SUM(rev) OVER c AS DOUBLE) AS cumulative_revenue
FROM d WINDOW a AS (ORDER BY order_date ROWS 6 PRECEDING), b AS (ORDER BY order_date ROWS 29 PRECEDING), c AS (ORDER BY order_date ROWS UNBOUNDED PRECEDING)
""")
def t_daily_revenue(t):
    return C.as_doubles(M.daily_revenue(C.orders(t)))


@query("t_dashboard", f"""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_date, SUM({money('o_totalprice')}) AS rev FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
w AS (SELECT order_date, CAST(rev AS DOUBLE) AS daily_revenue, CAST(SUM(rev) OVER a AS DOUBLE) / COUNT(*) OVER a AS moving_avg_7day,
  CAST(SUM(rev) OVER c AS DOUBLE) AS cumulative_revenue
  FROM d WINDOW a AS (ORDER BY order_date ROWS 6 PRECEDING), c AS (ORDER BY order_date ROWS UNBOUNDED PRECEDING))
SELECT order_date, daily_revenue, moving_avg_7day, daily_revenue - moving_avg_7day AS deviation_from_avg, cumulative_revenue
FROM w WHERE order_date >= {AS_OF} - INTERVAL 90 DAY
""")
def t_dashboard(t):
    return C.as_doubles(M.recent_trend(M.daily_revenue(C.orders(t)), as_of()))


@query("t_high_value", f"""
SELECT c_custkey AS customer_id, COUNT(*) AS total_orders, {total('o_totalprice')} AS total_spent, c_name AS customer_name
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1997-01-01'
GROUP BY c_custkey, c_name HAVING SUM({money('o_totalprice')}) > 500000
""")
def t_high_value(t):
    since = F.lit("1997-01-01").cast("date")
    return C.as_doubles(M.high_value_customers(C.orders(t), C.customers(t), 500000, since))


@query("t_partition_pruning", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_amount FROM orders
WHERE o_orderdate BETWEEN DATE '1997-07-01' AND DATE '1997-09-30'
""")
def t_partition_pruning(t):
    """Orders saved by year and quarter; the date range reads one of the folders."""
    path = scratch_path(t.spark, "orders-by-quarter")
    rows = C.orders(t).withColumns({"year": F.year("order_date"), "quarter": F.quarter("order_date")})
    rows.hint("rebalance", "year", "quarter").write.partitionBy("year", "quarter").parquet(path)
    saved = t.spark.read.schema(rows.schema).parquet(path)
    wanted = (F.col("year") == 1997) & (F.col("quarter") == 3)
    day = lambda s: F.lit(s).cast("date")
    return saved.filter(wanted & F.col("order_date").between(day("1997-07-01"), day("1997-09-30"))).select(
        "order_id", "customer_id", "order_date", F.col("total_amount").cast("double").alias("total_amount")
    )
