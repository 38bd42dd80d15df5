"""Data quality and validation."""

from pyspark.sql import functions as F

from quayside.functions import rules
from quayside.functions.exact import line_total
from quayside.operators import profile, quality as Q
from quayside.operators.columns import required_columns
from quayside.operators.relations import Role, Source, picked, relations
from quayside.plans import records as R
from quayside.plans.quarantine import write_quarantine
from quayside.queries.registry import query
from quayside.queries.sqltext import LINE_TOTAL
from quayside.queries.strings import EMAIL, EMAIL_RE, PHONE, email_text, phone_text
from quayside.session import scratch_path

# Order lines seen as sales records, with the flaws real records have.
SALES = """SELECT l_orderkey, l_linenumber, NULLIF(p_name, 'small ring') AS product, l_extendedprice AS price,
  CAST(l_quantity AS INTEGER) AS quantity,
  CASE WHEN l_tax = 0.07 THEN NULL WHEN l_tax = 0.08 THEN 'X' ELSE 'C' || LPAD(CAST(l_suppkey AS VARCHAR), 3, '0') END AS customer_id,
  l_returnflag AS region
FROM lineitem JOIN part ON l_partkey = p_partkey"""
LIMITS = dict(price_max=90000, quantity_min=3, quantity_max=45, valid_regions=("A", "N"), high_value_threshold=3_000_000)


def sales(t):
    product = F.nullif(F.col("p_name"), F.lit("small ring"))
    cid = F.when(F.col("l_tax") == 0.07, None).when(F.col("l_tax") == 0.08, "X").otherwise(
        F.concat(F.lit("C"), F.lpad(F.col("l_suppkey").cast("string"), 3, "0"))
    )
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", product.alias("product"), F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"), cid.alias("customer_id"), F.col("l_returnflag").alias("region"),
    )


def message_list(*cases: str) -> str:
    """A list of the messages whose case holds; blanks between are dropped."""
    return f"LIST_FILTER([{', '.join(cases)}], lambda m: m IS NOT NULL)"


MISSING = message_list(*[
    f"CASE WHEN {c} IS NULL{extra} THEN 'Missing required field: {c}' END"
    for c, extra in (("product", " OR product = ''"), ("price", ""), ("quantity", ""), ("customer_id", " OR customer_id = ''"), ("region", " OR region = ''"))
])
ERRORS = message_list(
    "CASE WHEN price < 0 THEN 'Price below minimum: ₹' || FORMAT('{:.2f}', price) END",
    "CASE WHEN price > 90000 THEN 'Price above maximum: ₹' || FORMAT('{:,.2f}', price) END",
    "CASE WHEN quantity < 3 THEN 'Quantity below minimum: ' || quantity END",
    "CASE WHEN region NOT IN ('A', 'N') THEN 'Invalid region: ' || region END",
    "CASE WHEN LENGTH(TRIM(product)) < 2 THEN 'Product name too short' END",
    "CASE WHEN NOT (customer_id LIKE 'C%') OR LENGTH(TRIM(customer_id)) < 4 THEN 'Invalid customer ID format: ' || TRIM(customer_id) END",
)
WARNINGS = message_list(
    "CASE WHEN quantity > 45 THEN 'Unusually high quantity: ' || quantity END",
    "CASE WHEN price * quantity > 3000000 THEN 'High-value order: ₹' || FORMAT('{:,.2f}', price * quantity) || ' - Requires approval' END",
)
CHECKED = f"""s AS ({SALES}), m AS (SELECT *, {MISSING} AS missing, {ERRORS} AS errs, {WARNINGS} AS warns FROM s),
c AS (SELECT *, CASE WHEN LEN(missing) > 0 THEN missing ELSE errs END AS errors, CASE WHEN LEN(missing) > 0 THEN [] ELSE warns END AS warnings FROM m)"""


def checked(t):
    rows = sales(t)
    return Q.check(rows, Q.sales_rules(rows, **LIMITS))


@query("d_validate_orders", f"""
WITH {CHECKED} SELECT l_orderkey, l_linenumber, LEN(errors) = 0 AS is_valid, ARRAY_TO_STRING(errors, '; ') AS errors,
  ARRAY_TO_STRING(warnings, '; ') AS warnings FROM c
""")
def d_validate_orders(t):
    return checked(t).select(
        "l_orderkey", "l_linenumber", (F.size("errors") == 0).alias("is_valid"),
        F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"),
    )


@query("d_validate_report", f"""
WITH {CHECKED} SELECT COUNT(*) AS total_records, COUNT(*) FILTER (LEN(errors) = 0) AS valid_records,
  COUNT(*) FILTER (LEN(errors) > 0) AS invalid_records, CAST(SUM(CASE WHEN LEN(errors) = 0 THEN LEN(warnings) ELSE 0 END) AS BIGINT) AS warnings FROM c
""")
def d_validate_report(t):
    return Q.totals(checked(t))


@query("d_validate_messages", f"""
WITH {CHECKED}, x AS (SELECT 'error' AS kind, UNNEST(errors) AS message FROM c
  UNION ALL SELECT 'warning', UNNEST(warnings) FROM c WHERE LEN(errors) = 0)
SELECT kind, message, COUNT(*) AS n FROM x GROUP BY kind, message
""")
def d_validate_messages(t):
    return Q.message_counts(checked(t))


LOWERED = SALES.replace("l_extendedprice AS price", "l_extendedprice - 3000 AS price")
BASIC = message_list(
    "CASE WHEN price <= 0 THEN 'Invalid price: ' || FORMAT('{:.2f}', price) END",
    "CASE WHEN quantity <= 0 THEN 'Invalid quantity: ' || quantity END",
    "CASE WHEN customer_id IS NULL OR TRIM(customer_id) = '' THEN 'Missing customer_id' END",
    "CASE WHEN product IS NULL OR LENGTH(product) < 2 THEN 'Invalid product name' END",
    "CASE WHEN region IS NULL OR region NOT IN ('A', 'N') THEN 'Invalid region: ' || COALESCE(region, 'None') END",
    "CASE WHEN price * quantity > 1000000 THEN 'High value order: ₹' || FORMAT('{:,.2f}', price * quantity) || ' - Needs approval' END",
)


def lowered(t):
    return sales(t).withColumn("price", F.col("price") - 3000)


@query("d_validate_basic", f"""
WITH s AS ({LOWERED}) SELECT l_orderkey, l_linenumber, ARRAY_TO_STRING({BASIC}, '; ') AS errors FROM s
""")
def d_validate_basic(t):
    rows = lowered(t)
    out = Q.check(rows, Q.basic_rules(rows, ("A", "N")))
    return out.select("l_orderkey", "l_linenumber", F.array_join("errors", "; ").alias("errors"))


@query("d_file_check", f"""
WITH s AS ({LOWERED}), v AS (SELECT *, price > 0 AND quantity > 0 AND customer_id IS NOT NULL AS ok FROM s)
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (ok) AS valid_records, COUNT(*) FILTER (ok) * 100.0::DOUBLE / COUNT(*) AS valid_pct,
       COUNT(*) FILTER (NOT ok) AS invalid_records, COUNT(*) FILTER (NOT ok) * 100.0::DOUBLE / COUNT(*) AS invalid_pct,
       CAST(SUM(CAST(price AS DECIMAL(12,2)) * CAST(quantity AS DECIMAL(6,0))) FILTER (ok) AS DOUBLE) AS total_revenue
FROM v
""")
def d_file_check(t):
    return Q.file_check(lowered(t))


@query("d_dq_suite", f"""
WITH i AS (
  SELECT 'Orders without items' AS issue_type, COUNT(*) AS issue_count FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'Products with negative prices', COUNT(*) FROM part WHERE p_retailprice < 0
  UNION ALL SELECT 'Orders with incorrect totals', COUNT(*) FROM orders JOIN (SELECT l_orderkey, SUM({LINE_TOTAL}) AS s FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey WHERE ABS(CAST(o_totalprice AS DECIMAL(12,2)) - s) > 0.01
  UNION ALL SELECT 'Customers with no orders', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT 'Orders with future dates', COUNT(*) FROM orders WHERE o_orderdate > DATE '2001-07-31')
SELECT issue_type, issue_count, CASE WHEN issue_count = 0 THEN 'PASS' WHEN issue_count < 10 THEN 'WARNING' ELSE 'FAIL' END AS status FROM i
""")
def d_dq_suite(t):
    """Each table is read once: see `operators.relations`."""
    found = relations([
        Source(t.orders, [
            Role("order lines", "o_orderkey", True, F.col("o_totalprice").cast("decimal(12,2)")), Role("customer orders", "o_custkey"),
        ], {"Orders with future dates": F.col("o_orderdate") > F.lit("2001-07-31").cast("timestamp_ntz")}),
        Source(t.lineitem, [Role("order lines", "l_orderkey", amount=line_total())]),
        Source(t.customer, [Role("customer orders", "c_custkey", True)]),
        Source(t.part, bad={"Products with negative prices": F.col("p_retailprice") < 0}),
    ])
    issues = picked(found, {
        "Orders without items": ("order lines", "without_children"),
        "Products with negative prices": ("Products with negative prices", "rows"),
        "Orders with incorrect totals": ("order lines", "wrong_totals"),
        "Customers with no orders": ("customer orders", "without_children"),
        "Orders with future dates": ("Orders with future dates", "rows"),
    })
    return issues.withColumn("status", Q.status(F.col("issue_count")))


CID = """CASE c_mktsegment WHEN 'BUILDING' THEN 'INVALID' WHEN 'MACHINERY' THEN ' c' || LPAD(CAST(c_custkey AS VARCHAR), 6, '0')
  WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN 'C' || c_custkey ELSE 'C' || c_custkey || 'A' END"""
DAY = "CASE WHEN c_nationkey >= 12 THEN '2024-' || c_nationkey || '-15' ELSE '2024-0' || (c_nationkey % 9 + 1) || '-15' END"
REGIONS = ("ASIA", "EUROPE", "AFRICA")


@query("d_field_rules", f"""
WITH r AS (SELECT c_custkey, {EMAIL} AS email, {PHONE} AS phone, c_acctbal AS price, c_nationkey * 500 AS quantity,
    {DAY} AS day, {CID} AS cid, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
k AS (SELECT *, UPPER(TRIM(cid)) AS k FROM r)
SELECT c_custkey, CASE WHEN NOT REGEXP_MATCHES(email, '{EMAIL_RE}') THEN 'Invalid email format' END AS email_error,
  CASE WHEN NOT REGEXP_MATCHES(REGEXP_REPLACE(phone, '[ -]', '', 'g'), '^[6-9]\\d{{9}}$') THEN 'Invalid phone number' END AS phone_error,
  CASE WHEN price < 0 THEN 'Price cannot be negative' WHEN price < 100 THEN 'Price below minimum: ₹100' WHEN price > 9000 THEN 'Price above maximum: ₹9000' END AS price_error,
  CASE WHEN quantity < 1 THEN 'Quantity below minimum: 1' WHEN quantity > 10000 THEN 'Quantity above maximum: 10000' END AS quantity_error,
  CASE WHEN TRY_STRPTIME(day, '%Y-%m-%d') IS NULL THEN 'Invalid date format. Expected: %Y-%m-%d' END AS date_error,
  CASE WHEN cid = '' THEN 'Customer ID is required' WHEN k NOT LIKE 'C%' THEN 'Customer ID must start with ''C''' WHEN LENGTH(k) < 4 THEN 'Customer ID too short (min: 4)'
       WHEN NOT REGEXP_MATCHES(k[2:], '^\\d+$') THEN 'Customer ID must end with numbers' END AS id_error,
  CASE WHEN region NOT IN ('ASIA', 'EUROPE', 'AFRICA') THEN 'Invalid region. Must be one of: ASIA, EUROPE, AFRICA' END AS region_error
FROM k
""")
def d_field_rules(t):
    seg, key, n = F.col("c_mktsegment"), F.col("c_custkey").cast("string"), F.col("c_nationkey")
    cid = (
        F.when(seg == "BUILDING", "INVALID").when(seg == "MACHINERY", F.concat(F.lit(" c"), F.lpad(key, 6, "0")))
        .when(seg == "HOUSEHOLD", "").when(seg == "FURNITURE", F.concat(F.lit("C"), key))
        .otherwise(F.concat(F.lit("C"), key, F.lit("A")))
    )
    day = F.when(n >= 12, F.concat(F.lit("2024-"), n.cast("string"), F.lit("-15"))).otherwise(
        F.concat(F.lit("2024-0"), (n % 9 + 1).cast("string"), F.lit("-15"))
    )
    rows = t.customer.join(t.nation, n == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    verdicts = {
        "email": rules.email(email_text()), "phone": rules.phone(phone_text()),
        "price": rules.price("c_acctbal", 100, 9000), "quantity": rules.quantity(n * 500),
        "date": rules.date(day), "id": rules.customer_id(cid), "region": rules.region("r_name", REGIONS),
    }
    return rows.select("c_custkey", *[v["error"].alias(f"{name}_error") for name, v in verdicts.items()])


RAW = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
    ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) END AS price,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL ELSE '2' END AS quantity,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS VARCHAR) WHEN o_orderstatus = 'O' THEN NULL ELSE 'c' || o_custkey END AS customer_id FROM orders"""


@query("d_error_class", f"""
WITH r AS ({RAW})
SELECT o_orderkey, CASE WHEN price IS NULL THEN 'Missing field: price' WHEN quantity IS NULL THEN 'Missing field: quantity'
  WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'Type error: price' WHEN TRY_CAST(quantity AS DOUBLE) IS NULL THEN 'Type error: quantity'
  WHEN customer_id IS NULL THEN 'Missing field: customer_id' WHEN TRY_CAST(customer_id AS DOUBLE) IS NOT NULL THEN 'Attribute error: customer_id'
  ELSE 'OK' END AS error_class FROM r
""")
def d_error_class(t):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    rows = t.orders.select(
        "o_orderkey",
        F.when(p == "5-LOW", "n/a").when((s == "P") & (p == "2-HIGH"), None)
        .otherwise(F.floor("o_totalprice").cast("bigint").cast("string")).alias("price"),
        F.when((p == "3-MEDIUM") & (s == "O"), None).otherwise("2").alias("quantity"),
        F.when(p == "1-URGENT", F.col("o_custkey").cast("string")).when(s == "O", None)
        .otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("customer_id"),
    )
    return rows.select("o_orderkey", Q.error_class(rows, "price", "quantity", "customer_id").alias("error_class"))


MEASURED = f"""s AS ({LOWERED}), e AS (SELECT *, {message_list(
    "CASE WHEN price < 0 THEN 'Price cannot be negative' WHEN price > 80000 THEN 'Price above maximum: ₹80000' END",
    "CASE WHEN quantity < 1 THEN 'Quantity below minimum: 1' WHEN quantity > 10000 THEN 'Quantity above maximum: 10000' END",
    "CASE WHEN customer_id IS NULL THEN 'Customer ID is required' WHEN customer_id NOT LIKE 'C%' THEN 'Customer ID must start with ''C''' END",
)} AS errors FROM s), v AS (SELECT *, LEN(errors) = 0 AS valid, CASE WHEN LEN(errors) = 0 THEN price * quantity END AS revenue FROM e),
f AS (SELECT *, revenue > 100000 AS discount_applied, CASE WHEN revenue > 100000 THEN revenue * (CAST(10 AS DOUBLE) / 100) END AS discount_amount,
  CASE WHEN revenue > 100000 THEN revenue - revenue * (CAST(10 AS DOUBLE) / 100) ELSE revenue END AS final_revenue FROM v)"""


@query("d_validate_measure", f"""
WITH {MEASURED} SELECT l_orderkey, l_linenumber, valid, ARRAY_TO_STRING(errors, '; ') AS errors, revenue, discount_applied, discount_amount, final_revenue FROM f
""")
def d_validate_measure(t):
    out = R.process_sales(lowered(t), 80000)
    return out.select(
        "l_orderkey", "l_linenumber", "valid", F.array_join("errors", "; ").alias("errors"), "revenue",
        "discount_applied", "discount_amount", "final_revenue",
    )


@query("d_validate_totals", f"""
WITH {MEASURED} SELECT COUNT(*) AS total_records, COUNT(*) FILTER (valid) AS valid_records, COUNT(*) FILTER (NOT valid) AS invalid_records,
  CAST(COUNT(*) FILTER (valid) AS DOUBLE) / COUNT(*) AS valid_share, ROUND(SUM(final_revenue), 2) AS total_revenue FROM f
""")
def d_validate_totals(t):
    out = R.sales_totals(R.process_sales(lowered(t), 80000))
    return out.withColumn("total_revenue", F.round("total_revenue", 2))


# Visits with gaps: failed ones have no reading, free ones no name.
VISITS = """SELECT user_id, CASE WHEN event_type <> 'signup' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN FLOOR(value / 10) * 10 END AS amount FROM events"""


def visits(t):
    kind = F.col("event_type")
    return t.events.select(
        "user_id", F.when(kind != "signup", kind).alias("event_type"),
        F.when(kind != "error", F.floor(F.col("value") / 10).cast("double") * 10).alias("amount"),
    )


@query("d_profile", f"""
WITH v AS ({VISITS}) SELECT COUNT(*) AS total_rows, CAST(3 AS BIGINT) AS total_columns,
  COUNT(*) FILTER (event_type IS NULL) + COUNT(*) FILTER (amount IS NULL) + COUNT(*) FILTER (user_id IS NULL) AS missing_values,
  CAST(COUNT(*) FILTER (event_type IS NULL) + COUNT(*) FILTER (amount IS NULL) + COUNT(*) FILTER (user_id IS NULL) AS DOUBLE) * 100 / (COUNT(*) * 3) AS missing_percentage,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM v)) AS duplicate_rows FROM v
""")
def d_profile(t):
    return profile.quality_profile(visits(t))


@query("d_required_columns", f"""
WITH v AS ({VISITS})
SELECT 'event_type' AS column_name, TRUE AS is_present, COUNT(event_type) AS filled FROM v UNION ALL SELECT 'amount', TRUE, COUNT(amount) FROM v
UNION ALL SELECT 'currency', FALSE, CAST(NULL AS BIGINT) UNION ALL SELECT 'user_id', TRUE, COUNT(user_id) FROM v
""")
def d_required_columns(t):
    """Visits must have a currency, which they lack."""
    return required_columns(visits(t), ["event_type", "amount", "currency", "user_id"])


@query("d_missing_profile", f"""
WITH v AS ({VISITS})
SELECT 'user_id' AS column_name, COUNT(*) FILTER (user_id IS NULL) AS missing_count, COUNT(*) FILTER (user_id IS NULL) * 100.0::DOUBLE / COUNT(*) AS missing_pct FROM v
UNION ALL SELECT 'event_type', COUNT(*) FILTER (event_type IS NULL), COUNT(*) FILTER (event_type IS NULL) * 100.0::DOUBLE / COUNT(*) FROM v
UNION ALL SELECT 'amount', COUNT(*) FILTER (amount IS NULL), COUNT(*) FILTER (amount IS NULL) * 100.0::DOUBLE / COUNT(*) FROM v
ORDER BY missing_count DESC
""")
def d_missing_profile(t):
    return profile.missing_profile(visits(t)).orderBy(F.col("missing_count").desc())


@query("d_constraints", """
SELECT 'primary key orders' AS check_name, (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)) AS violations
UNION ALL SELECT 'unique order and line', (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1))
UNION ALL SELECT 'foreign key line to order', (SELECT COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'foreign key order to customer', (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'foreign key document label', (SELECT COUNT(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'not null order date', (SELECT COUNT(*) FROM orders WHERE o_orderdate IS NULL)
""")
def d_constraints(t):
    """Each table is read once: see `operators.relations`."""
    found = relations([
        Source(t.orders, [Role("order lines", "o_orderkey", True), Role("customer orders", "o_custkey")],
               {"not null order date": F.col("o_orderdate").isNull()}),
        Source(t.lineitem, [Role("order lines", "l_orderkey", part="l_linenumber")]),
        Source(t.customer, [Role("customer orders", "c_custkey", True)]),
        Source(t.documents, [Role("document labels", "doc_id")]),
        Source(t.labels, [Role("document labels", "doc_id", True)]),
    ])
    issues = picked(found, {
        "primary key orders": ("order lines", "repeated_keys"),
        "unique order and line": ("order lines", "repeated_parts"),
        "foreign key line to order": ("order lines", "missing_parent"),
        "foreign key order to customer": ("customer orders", "missing_parent"),
        "foreign key document label": ("document labels", "missing_parent"),
        "not null order date": ("not null order date", "rows"),
    })
    return issues.select(F.col("issue_type").alias("check_name"), F.col("issue_count").alias("violations"))


@query("d_quarantine", f"""
WITH {CHECKED} SELECT LEN(errors) = 0 AS is_valid, COUNT(*) AS n, CAST(SUM(LEN(errors)) AS BIGINT) AS errors FROM c GROUP BY 1
""")
def d_quarantine(t):
    """All records written once, split by validity, and read back."""
    path = scratch_path(t.spark, "quarantine")
    write_quarantine(checked(t), path, "run1", "l_orderkey")
    saved = t.spark.read.parquet(f"{path}/run_id=run1/records")
    return saved.groupBy(F.col("is_valid").cast("boolean").alias("is_valid")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("errors").cast("bigint")).alias("errors")
    )
