"""Numeric functions and business measures."""

from pyspark.sql import functions as F

from quayside.functions import numbers as N
from quayside.functions.exact import round_half_up
from quayside.operators.narrowing import column_ranges
from quayside.queries.registry import query
from quayside.queries.sqltext import half_up


@query("n_arith", f"""
SELECT l_orderkey, l_linenumber, {half_up('l_extendedprice / l_quantity')} AS unit_price,
       ABS(l_discount - l_tax) AS gap, {half_up('l_discount * 100', 1)} AS discount_pct,
       CAST(l_orderkey AS BIGINT) % 7 AS remainder, CAST(FLOOR(l_extendedprice / 1000) AS BIGINT) AS thousands
FROM lineitem
""")
def n_arith(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", round_half_up(price / F.col("l_quantity")).alias("unit_price"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        round_half_up(F.col("l_discount") * 100, 1).alias("discount_pct"),
        (F.col("l_orderkey") % 7).alias("remainder"), F.floor(price / 1000).cast("bigint").alias("thousands"),
    )


@query("n_transforms", """
SELECT l_orderkey, l_linenumber, ROUND(LN(1 + l_extendedprice), 9) AS price_log, SQRT(l_extendedprice) AS price_sqrt,
       l_extendedprice * l_extendedprice AS price_squared, l_extendedprice / NULLIF(l_tax, 0) AS price_to_tax,
       l_quantity * l_extendedprice AS quantity_price
FROM lineitem
""")
def n_transforms(t):
    p = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(F.log1p(p), 9).alias("price_log"), F.sqrt(p).alias("price_sqrt"),
        F.pow(p, F.lit(2.0)).alias("price_squared"), N.safe_divide(p, "l_tax").alias("price_to_tax"),
        (F.col("l_quantity") * p).alias("quantity_price"),
    )


@query("n_bins", """
SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'Young' WHEN p_size > 10 AND p_size <= 25 THEN 'Adult'
  WHEN p_size > 25 AND p_size <= 40 THEN 'Middle-aged' WHEN p_size > 40 AND p_size <= 49 THEN 'Senior' END AS size_band FROM part
""")
def n_bins(t):
    band = N.bins("p_size", [0, 10, 25, 40, 49], ["Young", "Adult", "Middle-aged", "Senior"])
    return t.part.select("p_partkey", band.alias("size_band"))


# Amounts written in four ways by priority, LOW ones as words.
AMOUNT = """CASE o_orderpriority WHEN '1-URGENT' THEN '₹' || FORMAT('{:,}', CAST(FLOOR(o_totalprice) AS BIGINT))
  WHEN '2-HIGH' THEN CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || 'K'
  WHEN '3-MEDIUM' THEN ' ' || CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) || ' '
  WHEN '4-NOT SPECIFIED' THEN '0.' || CAST(CAST(FLOOR(o_totalprice / 100000) AS BIGINT) AS VARCHAR) || 'M'
  ELSE 'unknown' END"""


def amount_text():
    p, v = F.col("o_orderpriority"), F.col("o_totalprice")
    whole = lambda c: F.floor(c).cast("bigint")
    return (
        F.when(p == "1-URGENT", F.concat(F.lit("₹"), F.format_number(whole(v), 0)))
        .when(p == "2-HIGH", F.concat(whole(v / 1000).cast("string"), F.lit("K")))
        .when(p == "3-MEDIUM", F.concat(F.lit(" "), whole(v).cast("string"), F.lit(" ")))
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("0."), whole(v / 100000).cast("string"), F.lit("M")))
        .otherwise("unknown")
    )


@query("n_parse_amount", f"""
WITH w AS (SELECT o_orderkey, {AMOUNT} AS written FROM orders),
c AS (SELECT *, TRIM(REPLACE(REPLACE(written, '₹', ''), ',', '')) AS s FROM w)
SELECT o_orderkey, written, CASE WHEN s LIKE '%K' THEN TRY_CAST(RTRIM(s, 'K') AS DOUBLE) * 1000
  WHEN s LIKE '%M' THEN TRY_CAST(RTRIM(s, 'M') AS DOUBLE) * 1000000 ELSE TRY_CAST(s AS DOUBLE) END AS amount FROM c
""")
def n_parse_amount(t):
    rows = t.orders.select("o_orderkey", amount_text().alias("written"))
    return rows.withColumn("amount", N.parse_amount("written"))


WORD = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'no' WHEN '3-MEDIUM' THEN '1'
  WHEN '4-NOT SPECIFIED' THEN 'FALSE' ELSE 'maybe' END"""


@query("n_parse_bool", f"""
WITH w AS (SELECT o_orderkey, {WORD} AS written FROM orders)
SELECT o_orderkey, CASE WHEN written IN ('Yes','yes','YES','True','true','TRUE','1') THEN TRUE
  WHEN written IN ('No','no','NO','False','false','FALSE','0') THEN FALSE END AS flag FROM w
""")
def n_parse_bool(t):
    p = F.col("o_orderpriority")
    word = F.when(p == "1-URGENT", "Yes").when(p == "2-HIGH", "no").when(p == "3-MEDIUM", "1").when(
        p == "4-NOT SPECIFIED", "FALSE").otherwise("maybe")
    return t.orders.select("o_orderkey", N.parse_bool(word).alias("flag"))


@query("n_coerce", """
SELECT doc_id, TRY_CAST(SUBSTRING(source, 4) AS BIGINT) AS source_number, TRY_CAST(lang AS DOUBLE) AS lang_number FROM documents
""")
def n_coerce(t):
    return t.documents.select(
        "doc_id", N.to_number(F.substring("source", 4, 10), "bigint").alias("source_number"),
        N.to_number("lang").alias("lang_number"),
    )


def _int_range(c, dtype):
    return f"""SELECT '{c}' AS column_name, '{dtype}' AS source_type, CAST(MIN({c}) AS BIGINT) AS min_value, CAST(MAX({c}) AS BIGINT) AS max_value,
  CAST(NULL AS BIGINT) AS distinct_values,
  CASE WHEN MIN({c}) >= -128 AND MAX({c}) <= 127 THEN 'tinyint' WHEN MIN({c}) >= -32768 AND MAX({c}) <= 32767 THEN 'smallint'
       WHEN MIN({c}) >= -2147483648 AND MAX({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type,
  CAST(NULL AS BOOLEAN) AS low_cardinality FROM customer"""


def _text_range(c):
    return f"""SELECT '{c}', 'string', NULL, NULL, COUNT(DISTINCT {c}), 'string', COUNT(DISTINCT {c}) < COUNT(*) * 0.5 FROM customer"""


@query("n_narrow_types", " UNION ALL ".join([
    _int_range("c_custkey", "bigint"), _text_range("c_name"), _int_range("c_nationkey", "int"),
    "SELECT 'c_acctbal', 'double', NULL, NULL, NULL, 'float', NULL", _text_range("c_mktsegment"),
]))
def n_narrow_types(t):
    return column_ranges(t.customer)


@query("n_profit_margin", f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_size <= 5 THEN 0 ELSE p_retailprice END AS revenue, p_retailprice * 0.6 AS cost FROM part)
SELECT p_partkey, revenue - cost AS profit, CASE WHEN revenue = 0 THEN 0.0 ELSE (revenue - cost) / revenue END AS margin,
       {half_up('CASE WHEN revenue = 0 THEN 0.0 ELSE (revenue - cost) / revenue * 100 END')} AS margin_pct,
       CASE WHEN revenue = 0 THEN 0.0 ELSE (cost - revenue) / revenue * 100 END AS roi
FROM p
""")
def n_profit_margin(t):
    rows = t.part.select(
        "p_partkey", F.when(F.col("p_size") <= 5, 0.0).otherwise(F.col("p_retailprice")).alias("revenue"),
        (F.col("p_retailprice") * 0.6).alias("cost"),
    )
    margin = N.profit_margin("revenue", "cost")
    return rows.select(
        "p_partkey", N.profit("revenue", "cost").alias("profit"), margin.alias("margin"),
        round_half_up(margin * 100).alias("margin_pct"), N.roi("revenue", "cost").alias("roi"),
    )


@query("n_discount_tax", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice * (l_discount * 100 / 100) AS amt, l_extendedprice, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice - amt AS discounted_price, amt AS discount_amount,
       l_extendedprice + l_extendedprice * l_tax AS total_with_tax, l_extendedprice * l_tax AS tax_amount FROM d
""")
def n_discount_tax(t):
    d = N.discount("l_extendedprice", F.col("l_discount") * 100)
    x = N.tax("l_extendedprice", "l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", d["price"].alias("discounted_price"), d["amount"].alias("discount_amount"),
        x["total"].alias("total_with_tax"), x["amount"].alias("tax_amount"),
    )


SIZE = "l_extendedprice * l_extendedprice * l_quantity"


@query("n_format", f"""
SELECT l_orderkey, l_linenumber, '₹' || FORMAT('{{:,.2f}}', l_extendedprice) AS currency, FORMAT('{{:,.0f}}', FLOOR(l_extendedprice)) AS number,
       CASE WHEN l_discount BETWEEN 0 AND 1 THEN FORMAT('{{:.1f}}%', l_discount * 100) ELSE FORMAT('{{:.1f}}%', l_discount) END AS percent,
       CASE WHEN {SIZE} < 1024 THEN FORMAT('{{:.2f}} B', {SIZE}) WHEN {SIZE} < 1048576 THEN FORMAT('{{:.2f}} KB', {SIZE} / 1024)
            WHEN {SIZE} < 1073741824 THEN FORMAT('{{:.2f}} MB', {SIZE} / 1048576)
            WHEN {SIZE} < 1099511627776 THEN FORMAT('{{:.2f}} GB', {SIZE} / 1073741824)
            WHEN {SIZE} < 1125899906842624 THEN FORMAT('{{:.2f}} TB', {SIZE} / 1099511627776)
            ELSE FORMAT('{{:.2f}} PB', {SIZE} / 1125899906842624) END AS file_size
FROM lineitem
""")
def n_format(t):
    p = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", N.format_currency(p).alias("currency"), N.format_number(F.floor(p)).alias("number"),
        N.format_percentage("l_discount").alias("percent"), N.format_file_size(p * p * F.col("l_quantity")).alias("file_size"),
    )
