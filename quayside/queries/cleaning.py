"""Filling, outliers, scaling, encoding, and the cleaning and feature runs."""

from pyspark.sql import functions as F

from quayside.operators import encoding as E, missing as M, outliers as OUT, scaling as SC
from quayside.plans import features
from quayside.plans.cleaning import clean
from quayside.queries.registry import query
from quayside.queries.sqltext import mean, total
from quayside.session import materialise

# Readings of failed events count as unknown.
GAPS = "SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events"


def gaps(t):
    return t.events.select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))


@query("m_fill_numeric", f"""
WITH e AS ({GAPS}), s AS (SELECT AVG(v) AS mean, QUANTILE_CONT(v, 0.5) AS median FROM e),
m AS (SELECT v AS mode FROM e WHERE v IS NOT NULL GROUP BY v ORDER BY COUNT(*) DESC, v LIMIT 1)
SELECT event_id, ROUND(COALESCE(v, mean), 6) AS v_mean, COALESCE(v, median) AS v_median, COALESCE(v, mode) AS v_mode, COALESCE(v, 0.0) AS v_zero
FROM e, s, m
""")
def m_fill_numeric(t):
    rows = gaps(t)
    for how in ("mean", "median", "mode", "zero"):
        rows = M.fill(rows, M.learn_fill(gaps(t), {"v": how}), suffix=f"_{how}")
    return rows.withColumn("v_mean", F.round("v_mean", 6)).drop("v", "user_id")


HOLES = "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN '' ELSE c_mktsegment END AS seg FROM customer"


def holes(t):
    bal = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.when(bal < 0, None).when(bal > 9000, "").otherwise(F.col("c_mktsegment")).alias("seg")
    )


@query("m_fill_text", f"""
WITH h AS ({HOLES}), m AS (SELECT seg AS mode FROM h WHERE seg IS NOT NULL GROUP BY seg ORDER BY COUNT(*) DESC, seg LIMIT 1)
SELECT c_custkey, COALESCE(seg, mode) AS seg_mode, COALESCE(seg, 'Unknown Customer') AS seg_constant, COALESCE(seg, '') AS seg_empty,
       COALESCE(seg, 'Missing') AS seg_class FROM h, m
""")
def m_fill_text(t):
    rows = holes(t)
    for suffix, how in (("mode", "mode"), ("constant", "const:Unknown Customer"), ("empty", "const:"), ("class", "const:Missing")):
        rows = M.fill(rows, M.learn_fill(holes(t), {"seg": how}), suffix=f"_{suffix}")
    return rows.drop("seg")


PARTLY = "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v, CASE WHEN event_type NOT IN ('error', 'click') THEN user_id END AS u FROM events"


@query("m_drop_rows", f"""
WITH e AS ({PARTLY})
SELECT 'any' AS kind, event_id FROM e WHERE v IS NOT NULL AND u IS NOT NULL
UNION ALL SELECT 'all', event_id FROM e WHERE v IS NOT NULL OR u IS NOT NULL
UNION ALL SELECT 'subset', event_id FROM e WHERE v IS NOT NULL
""")
def m_drop_rows(t):
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id", F.when(kind != "error", F.col("value")).alias("v"),
        F.when(~kind.isin("error", "click"), F.col("user_id")).alias("u"),
    )
    tag = lambda name, df: df.select(F.lit(name).alias("kind"), "event_id")
    return (
        tag("any", M.drop_rows(rows)).unionByName(tag("all", M.drop_rows(rows, "all", ["v", "u"])))
        .unionByName(tag("subset", M.drop_rows(rows, subset=["v"])))
    )


BOUNDS = """b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM events))"""


@query("m_iqr", f"""
WITH {BOUNDS} SELECT event_id, value, ROUND(lo, 6) AS lower_bound, ROUND(hi, 6) AS upper_bound FROM events, b WHERE value < lo OR value > hi
""")
def m_iqr(t):
    out = OUT.iqr_outliers(t.events.select("event_id", "value"), "value")
    return out.withColumns({c: F.round(c, 6) for c in ("lower_bound", "upper_bound")})


@query("m_zscore", """
WITH s AS (SELECT AVG(value) AS m, STDDEV_POP(value) AS s FROM events)
SELECT event_id, value, ROUND(ABS(value - m) / s, 6) AS z_score FROM events, s WHERE ABS(value - m) / s > 3
""")
def m_zscore(t):
    out = OUT.zscore_outliers(t.events.select("event_id", "value"), "value")
    return out.withColumn("z_score", F.round("z_score", 6))


@query("m_outlier_remove", f"WITH {BOUNDS} SELECT event_id, value FROM events, b WHERE value BETWEEN lo AND hi")
def m_outlier_remove(t):
    rows = t.events.select("event_id", "value")
    return OUT.remove_outliers(rows, "value", OUT.iqr_bounds(rows, ["value"]).get("value"))


@query("m_outlier_cap", f"""
WITH {BOUNDS} SELECT event_id, value, ROUND(LEAST(GREATEST(value, lo), hi), 6) AS value_capped FROM events, b
""")
def m_outlier_cap(t):
    rows = t.events.select("event_id", "value")
    out = OUT.cap_outliers(rows, OUT.iqr_bounds(rows, ["value"]), "_capped")
    return out.withColumn("value_capped", F.round("value_capped", 6))


def moments_sql(name: str, x: str, source: str) -> str:
    return f"""SELECT '{name}' AS method, COUNT({x}) AS count, ROUND(AVG({x}), 6) AS mean, ROUND(STDDEV_SAMP({x}), 6) AS std,
  ROUND(MIN({x}), 6) AS min, ROUND(MAX({x}), 6) AS max, ROUND(SKEWNESS({x}), 4) AS skew FROM {source}"""


def rounded(df):
    cols = {c: F.round(c, 6) for c in ("mean", "std", "min", "max") if c in df.columns}
    if "skew" in df.columns:
        cols["skew"] = F.round("skew", 4)
    return df.withColumns(cols)


@query("m_log", moments_sql("Original", "value", "events") + " UNION ALL " + moments_sql("Log Transformed", "LN(1 + value)", "events"))
def m_log(t):
    return rounded(OUT.moments_table(t.events, {"Original": F.col("value"), "Log Transformed": F.log1p("value")}))


@query("m_outlier_compare", f"""
WITH {BOUNDS}, e AS (SELECT value, CASE WHEN value BETWEEN lo AND hi THEN value END AS kept, LEAST(GREATEST(value, lo), hi) AS capped FROM events, b)
{moments_sql("Original", "value", "e")} UNION ALL {moments_sql("Removed", "kept", "e")}
UNION ALL {moments_sql("Capped", "capped", "e")} UNION ALL {moments_sql("Log Transformed", "LN(1 + value)", "e")}
""")
def m_outlier_compare(t):
    return rounded(OUT.compare_strategies(t.events, "value"))


@query("m_standard", """
WITH s AS (SELECT AVG(c_acctbal) AS a, STDDEV_POP(c_acctbal) AS b, AVG(c_nationkey) AS c, STDDEV_POP(c_nationkey) AS d FROM customer)
SELECT c_custkey, ROUND((c_acctbal - a) / b, 6) AS c_acctbal_z, ROUND((c_nationkey - c) / d, 6) AS c_nationkey_z FROM customer, s
""")
def m_standard(t):
    rows = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    out = SC.scale(rows, ["c_acctbal", "c_nationkey"], "standard", "_z")
    return out.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("c_acctbal_z", "c_nationkey_z")])


@query("m_minmax", """
WITH s AS (SELECT MIN(c_acctbal) AS a, MAX(c_acctbal) - MIN(c_acctbal) AS b, MIN(c_nationkey) AS c, MAX(c_nationkey) - MIN(c_nationkey) AS d FROM customer)
SELECT c_custkey, (c_acctbal - a) / b AS c_acctbal_01, (c_nationkey - c) / CAST(d AS DOUBLE) AS c_nationkey_01 FROM customer, s
""")
def m_minmax(t):
    rows = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    return SC.scale(rows, ["c_acctbal", "c_nationkey"], "minmax", "_01").drop("c_acctbal", "c_nationkey")


@query("m_robust", """
WITH s AS (SELECT QUANTILE_CONT(c_acctbal, 0.5) AS m, QUANTILE_CONT(c_acctbal, 0.75) - QUANTILE_CONT(c_acctbal, 0.25) AS w FROM customer)
SELECT c_custkey, ROUND((c_acctbal - m) / w, 9) AS c_acctbal_r FROM customer, s
""")
def m_robust(t):
    out = SC.scale(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], "robust", "_r")
    return out.select("c_custkey", F.round("c_acctbal_r", 9).alias("c_acctbal_r"))


def scaling_sql(name: str, x: str) -> str:
    return f"""SELECT '{name}' AS method, ROUND(MIN({x}), 6) AS min, ROUND(MAX({x}), 6) AS max,
  ROUND(ABS(AVG({x})), 6) AS mean, ROUND(STDDEV_SAMP({x}), 6) AS std FROM customer, s"""


@query("m_scale_compare", f"""
WITH s AS (SELECT AVG(c_acctbal) AS a, STDDEV_POP(c_acctbal) AS b, MIN(c_acctbal) AS c, MAX(c_acctbal) - MIN(c_acctbal) AS d,
  QUANTILE_CONT(c_acctbal, 0.5) AS e, QUANTILE_CONT(c_acctbal, 0.75) - QUANTILE_CONT(c_acctbal, 0.25) AS f FROM customer)
{scaling_sql("Original", "c_acctbal")} UNION ALL {scaling_sql("Standardized", "((c_acctbal - a) / b)")}
UNION ALL {scaling_sql("Normalized", "((c_acctbal - c) / d)")} UNION ALL {scaling_sql("Robust", "((c_acctbal - e) / f)")}
""")
def m_scale_compare(t):
    out = SC.compare_scalings(t.customer, "c_acctbal")
    return rounded(out.withColumn("mean", F.abs("mean")))


@query("e_onehot", """
SELECT c_custkey, """ + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS segment_{s}"
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def e_onehot(t):
    return E.one_hot(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment")


@query("e_levels", "SELECT c_name AS level, ROW_NUMBER() OVER (ORDER BY c_name) - 1 AS level_no FROM (SELECT DISTINCT c_name FROM customer)")
def e_levels(t):
    """As many levels as customers: the dictionary is a table, its size decides nothing."""
    return E.level_table(t.customer, "c_name")


@query("e_onehot_vector", """
WITH lv AS (SELECT p_type, ROW_NUMBER() OVER (ORDER BY p_type) - 1 AS no FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 40)),
n AS (SELECT COUNT(*) AS size FROM lv)
SELECT p_partkey, size, COALESCE(no, -1) AS level_no, CASE WHEN no IS NULL THEN 0 ELSE 1 END AS entries, CASE WHEN no = 0 THEN 1 ELSE 0 END AS is_first
FROM n, part LEFT JOIN lv USING (p_type)
""")
def e_onehot_vector(t):
    """The dictionary is learned from the smaller parts; types that only larger ones have get no index."""
    levels = materialise(E.level_table(t.part.filter("p_size <= 40"), "p_type"), "levels")
    out = E.one_hot_vector(t.part.select("p_partkey", "p_type"), "p_type", levels, "hot")
    hot = F.col("hot")
    return out.select(
        "p_partkey", hot["size"].alias("size"), F.coalesce(F.get(hot["indices"], 0), F.lit(-1)).alias("level_no"),
        F.size(hot["values"]).alias("entries"), E.at_level(hot, 0).alias("is_first"),
    )


LABELS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


@query("e_label", """
SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
  WHEN 'HOUSEHOLD' THEN 4 END AS segment_encoded FROM customer
""")
def e_label(t):
    return E.label_encode(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", LABELS, "segment_encoded")


@query("e_frequency", """
SELECT o_orderkey, o_orderpriority, COUNT(*) OVER (PARTITION BY o_orderpriority) / CAST(COUNT(*) OVER () AS DOUBLE) AS priority_frequency FROM orders
""")
def e_frequency(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return E.frequency_encode(rows, "o_orderpriority", "priority_frequency")


@query("e_interactions", """
SELECT p_partkey, p_brand || '_' || p_type AS p_brand_p_type, p_size * p_retailprice AS p_size_p_retailprice_product,
       p_size / (p_retailprice + 1) AS p_size_p_retailprice_ratio FROM part
""")
def e_interactions(t):
    rows = t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    out = features.interaction_features(rows, [("p_brand", "p_type")], "p_size", "p_retailprice")
    return out.drop("p_brand", "p_type", "p_size", "p_retailprice")


RAW = """raw AS (SELECT event_id, user_id, ' ' || UPPER(event_type) || ' ' AS visit_name,
    CASE WHEN event_type <> 'signup' THEN ' U' || user_id || '@X.COM' END AS email, '+91 ' || (9000000000 + user_id) AS phone,
    CASE WHEN event_type <> 'error' THEN FLOOR(value / 10) * 10 END AS amount FROM events)"""
FILLED = """fill AS (SELECT event_id, user_id, visit_name, COALESCE(email, (SELECT email FROM raw WHERE email IS NOT NULL GROUP BY email ORDER BY COUNT(*) DESC, email LIMIT 1)) AS email,
    phone, COALESCE(amount, (SELECT QUANTILE_CONT(amount, 0.5) FROM raw)) AS amount FROM raw),
uniq AS (SELECT * FROM fill QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, visit_name, email, phone, amount ORDER BY event_id) = 1)"""


def visits(t):
    """Visits with gaps, repeats, outliers and messy text."""
    kind, user = F.col("event_type"), F.col("user_id")
    return t.events.select(
        "event_id", "user_id", F.concat(F.lit(" "), F.upper(kind), F.lit(" ")).alias("visit_name"),
        F.when(kind != "signup", F.concat(F.lit(" U"), user.cast("string"), F.lit("@X.COM"))).alias("email"),
        F.concat(F.lit("+91 "), (F.lit(9000000000) + user).cast("string")).alias("phone"),
        F.when(kind != "error", F.floor(F.col("value") / 10).cast("double") * 10).alias("amount"),
    )


@query("e_clean_all", f"""
WITH {RAW}, {FILLED},
q AS (SELECT QUANTILE_CONT(amount, 0.25) AS a1, QUANTILE_CONT(amount, 0.75) AS a3, QUANTILE_CONT(user_id, 0.25) AS u1, QUANTILE_CONT(user_id, 0.75) AS u3 FROM uniq)
SELECT event_id, CAST(LEAST(GREATEST(user_id, u1 - 1.5 * (u3 - u1)), u3 + 1.5 * (u3 - u1)) AS DOUBLE) AS user_id,
  UPPER(TRIM(visit_name)[1]) || LOWER(TRIM(visit_name)[2:]) AS visit_name, LOWER(TRIM(email)) AS email,
  REGEXP_REPLACE(phone, '\\D', '', 'g') AS phone, LEAST(GREATEST(amount, a1 - 1.5 * (a3 - a1)), a3 + 1.5 * (a3 - a1)) AS amount
FROM uniq, q
""")
def e_clean_all(t):
    """The column types found by the last step depend on the data, so numbers
    are compared as doubles."""
    cleaned, _ = clean(visits(t), "event_id")
    return cleaned.withColumns({
        "event_id": F.col("event_id").cast("bigint"), "user_id": F.col("user_id").cast("double"),
        "amount": F.col("amount").cast("double"),
    })


@query("d_clean_report", f"""
WITH {RAW}, {FILLED}, n AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (email IS NULL) + COUNT(*) FILTER (amount IS NULL) AS missing FROM raw)
SELECT 'analyze_quality' AS step, 'total_rows' AS figure, total AS value FROM n UNION ALL SELECT 'analyze_quality', 'missing_values', missing FROM n
UNION ALL SELECT 'handle_missing', 'filled', missing FROM n UNION ALL SELECT 'handle_missing', 'after', 0
UNION ALL SELECT 'remove_duplicates', 'after', COUNT(*) FROM uniq UNION ALL SELECT 'remove_duplicates', 'removed', total - (SELECT COUNT(*) FROM uniq) FROM n
""")
def d_clean_report(t):
    """Figures of the cleaning run's report."""
    _, report = clean(visits(t), "event_id")
    wanted = {"analyze_quality": ("total_rows", "missing_values"), "handle_missing": ("filled", "after"), "remove_duplicates": ("after", "removed")}
    rows = [(step, f, figures[f]) for step, figures in report.steps for f in wanted.get(step, ())]
    return t.spark.createDataFrame(rows, "step string, figure string, value long")


@query("m_drop_columns", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events")
def m_drop_columns(t):
    """Values known for one event type in five fall under the threshold; the other column stays."""
    kind, value = F.col("event_type"), F.col("value")
    rows = t.events.select(
        "event_id", F.when(kind != "error", value).alias("v"), F.when(kind == "click", value).alias("rare")
    )
    return M.drop_sparse_columns(rows, 0.5)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("e_feature_all", f"""
WITH r AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount, c_acctbal AS balance, c_name AS name,
    o_orderpriority AS priority, c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT o_custkey AS k, COUNT(*) AS purchase_count, SUM(amount) AS total_spent, AVG(amount) AS avg_purchase, MAX(amount) AS max_purchase,
    MIN(amount) AS min_purchase, STDDEV_SAMP(amount) AS sd FROM r GROUP BY o_custkey),
f AS (SELECT segment AS g, COUNT(*) / CAST((SELECT COUNT(*) FROM r) AS DOUBLE) AS segment_frequency FROM r GROUP BY segment)
SELECT o_orderkey, o_custkey, order_date, amount, balance, name, priority, segment,
  YEAR(d) AS purchase_year, MONTH(d) AS purchase_month, DAY(d) AS purchase_day, ISODOW(d) - 1 AS purchase_weekday, QUARTER(d) AS purchase_quarter,
  WEEKOFYEAR(d) AS purchase_week_of_year, CASE WHEN ISODOW(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN DAY(d) = 1 THEN 1 ELSE 0 END AS is_month_start,
  CASE WHEN d = LAST_DAY(d) THEN 1 ELSE 0 END AS is_month_end,
  CASE WHEN MONTH(d) IN (12, 1, 2) THEN 'Winter' WHEN MONTH(d) IN (3, 4, 5) THEN 'Summer' WHEN MONTH(d) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END AS season,
  CASE WHEN balance > 0 AND balance <= 2500 THEN 'Low' WHEN balance > 2500 AND balance <= 5000 THEN 'Medium' WHEN balance > 5000 AND balance <= 7500 THEN 'High'
       WHEN balance > 7500 AND balance <= 10000 THEN 'Very High' END AS balance_band,
  ROUND(LN(1 + amount), 9) AS amount_log, SQRT(amount) AS amount_sqrt, amount * amount AS amount_squared, amount / NULLIF(balance, 0) AS amount_to_balance_ratio,
  amount * balance AS balance_amount_interaction,
  {", ".join(f"CASE WHEN priority = '{p}' THEN 1 ELSE 0 END AS \"category_{p}\"" for p in PRIORITIES)},
  CASE segment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 END AS segment_encoded, segment_frequency,
  purchase_count, ROUND(total_spent, 2) AS total_spent, ROUND(avg_purchase, 7) AS avg_purchase, max_purchase, min_purchase, ROUND(sd, 3) AS purchase_std, max_purchase - min_purchase AS purchase_range,
  ROUND(sd / avg_purchase, 6) AS purchase_cv, LENGTH(name) AS name_length, CAST(1 AS BIGINT) AS name_word_count, name AS name_first_word,
  CASE WHEN CONTAINS(LOWER(name), '99') THEN 1 ELSE 0 END AS name_has_99,
  segment || '_' || priority AS segment_priority, balance * amount AS balance_amount_product, balance / (amount + 1) AS balance_amount_ratio,
  LAG(amount, 1) OVER w AS prev_value, LAG(amount, 2) OVER w AS prev_2_value,
  ROUND(AVG(amount) OVER (w ROWS 2 PRECEDING), 6) AS rolling_avg_3,
  CAST(DATE_DIFF('day', LAG(d) OVER w, d) AS BIGINT) AS days_since_last
FROM r JOIN s ON o_custkey = k JOIN f ON segment = g WINDOW w AS (PARTITION BY o_custkey ORDER BY order_date, o_orderkey)
""")
def e_feature_all(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("amount"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
    )
    # Five of the steps read the joined rows, so they are written once.
    out = features.all_features(
        materialise(rows, "purchases"), "o_custkey", "o_orderkey", "order_date", "amount", "balance", "name", "priority", "segment",
        LABELS, ((0, 2500, 5000, 7500, 10000), ("Low", "Medium", "High", "Very High")), "99",
    )
    return out.withColumns({
        "amount_log": F.round("amount_log", 9), "purchase_std": F.round("purchase_std", 3), "purchase_cv": F.round("purchase_cv", 6),
        "total_spent": F.round("total_spent", 2), "avg_purchase": F.round("avg_purchase", 7), "rolling_avg_3": F.round("rolling_avg_3", 6),
    })
