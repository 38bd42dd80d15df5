"""Sources and sinks: tables written and read back in other forms."""

import uuid

from pyspark.sql import functions as F

from quayside.functions import nested as J
from quayside.functions.exact import exact_sum
from quayside.sources import catalog, files, ingest, payloads, refresh
from quayside.queries.registry import query
from quayside.queries.sqltext import total
from quayside.session import materialise, scratch_path


@query("s_scan_sum", f"SELECT {total('l_extendedprice')} AS total, COUNT(*) AS rows FROM lineitem")
def s_scan_sum(t):
    return t.lineitem.agg(exact_sum("l_extendedprice").alias("total"), F.count(F.lit(1)).alias("rows"))


@query("s_csv_roundtrip", """
SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day FROM orders
""")
def s_csv_roundtrip(t):
    """Written with a NA token and ';', read back with chosen columns and types."""
    path = scratch_path(t.spark, "orders-csv")
    status = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus"))
    rows = t.orders.withColumns({"o_orderstatus": status, "order_day": F.date_format("o_orderdate", "dd/MM/yyyy")})
    files.write_csv(rows.drop("o_orderdate"), path, sep=";")
    return files.read_csv_advanced(
        t.spark, path, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_day"],
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}, {"order_day": "dd/MM/yyyy"}, sep=";",
    )


@query("s_jsonl_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def s_jsonl_roundtrip(t):
    path = scratch_path(t.spark, "conversations-jsonl")
    files.write_jsonl(t.conversations, path)
    return files.read_jsonl(t.spark, path, t.conversations.schema)


@query("s_csv_text", "SELECT doc_id, text FROM documents")
def s_csv_text(t):
    """Quotes, line breaks and accents survive the CSV form."""
    path = scratch_path(t.spark, "documents-csv")
    rows = t.documents.select("doc_id", "text")
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema, multiline=True)


@query("s_json_props", """
SELECT event_id, CAST(JSON_EXTRACT(props, '$.k') AS BIGINT) AS k, JSON_EXTRACT_STRING(props, '$.k') AS k_text FROM events
""")
def s_json_props(t):
    rows = t.events.select("event_id", F.inline(J.json_records("props", "struct<k:bigint>")), "props")
    return rows.select("event_id", "k", F.get_json_object("props", "$.k").alias("k_text"))


@query("s_price_payload", """
SELECT o_custkey, o_orderpriority AS entity, MAX(o_totalprice) AS usd, MIN(o_totalprice) AS inr FROM orders GROUP BY ALL
""")
def s_price_payload(t):
    """Per customer a JSON map keyed by entity, as a price API sends it, flattened again.

    A map holds one entry per entity, as the rows were grouped by it first."""
    per = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max("o_totalprice").alias("usd"), F.min("o_totalprice").alias("inr")
    )
    entry = F.struct("o_orderpriority", F.struct("usd", "inr"))
    body = per.groupBy("o_custkey").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("body"))
    out = payloads.entity_rows(body, "body", F.lit("2025-01-01").cast("date"), "map<string,struct<usd:double,inr:double>>")
    return out.select("o_custkey", "entity", "usd", "inr")


@query("s_param_sql", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000
""")
def s_param_sql(t):
    t.register("orders")
    return catalog.run_sql(
        t.spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = :status AND o_totalprice > :low",
        status="F", low=300000,
    )


@query("s_lineage_tag", """
SELECT n_nationkey AS key, n_name AS name, 'nation' AS data_source, TIMESTAMP '2025-01-01 00:00:00' AS ingestion_timestamp FROM nation
UNION ALL SELECT c_custkey, c_name, 'customer', TIMESTAMP '2025-01-01 00:00:00' FROM customer
""")
def s_lineage_tag(t):
    at = F.lit("2025-01-01 00:00:00").cast("timestamp")
    a = t.nation.select(F.col("n_nationkey").cast("bigint").alias("key"), F.col("n_name").alias("name"))
    b = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return ingest.tag_source(a, "nation", at).unionByName(ingest.tag_source(b, "customer", at))


@query("s_ingest_run", """
SELECT 'customer' AS source, 'success' AS status, COUNT(*) AS records FROM customer UNION ALL SELECT 'orders', 'success', COUNT(*) FROM orders
UNION ALL SELECT 'lost', 'failed', 0
""")
def s_ingest_run(t):
    """Two sources that load and one that is missing: the others are not stopped."""
    sources = {
        "customer": lambda s: t.customer, "orders": lambda s: t.orders,
        "lost": lambda s: s.read.parquet(f"{t.folder}/no-such-table.parquet"),
    }
    status = ingest.ingest(t.spark, sources, scratch_path(t.spark, "ingest"), "run1")
    return status.select("source", "status", "records")


@query("s_csv_inferred", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'double' AS price_type FROM orders")
def s_csv_inferred(t):
    """Without a schema: keys come back as whole numbers, prices as doubles."""
    path = scratch_path(t.spark, "orders-inferred")
    files.write_csv(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    back = files.read_csv(t.spark, path)
    return back.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("o_orderkey", "o_custkey")], "o_orderstatus", "o_totalprice",
        F.typeof("o_totalprice").alias("price_type"),
    )


@query("s_csv_records", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_linestatus FROM lineitem
""")
def s_csv_records(t):
    path = scratch_path(t.spark, "lines-records")
    files.write_csv(t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus"), path)
    return files.read_csv_records(t.spark, path)


@query("s_json_documents", "SELECT s_suppkey, s_name, s_nationkey, s_suppkey // 100 AS doc FROM supplier")
def s_json_documents(t):
    """Documents that each hold an array of up to 100 suppliers, one file each."""
    path = scratch_path(t.spark, "suppliers-json")
    record = F.struct("s_suppkey", "s_name", "s_nationkey")
    docs = t.supplier.groupBy(F.floor(F.col("s_suppkey") / 100).alias("doc")).agg(F.to_json(F.collect_list(record)).alias("value"))
    docs.write.partitionBy("doc").text(path)
    return files.read_json(t.spark, path, f"s_suppkey long, s_name string, s_nationkey {dict(t.supplier.dtypes)['s_nationkey']}, doc long")


@query("s_list_objects", "SELECT DISTINCT c_mktsegment AS segment FROM customer")
def s_list_objects(t):
    """A table in one folder per segment, listed without reading it."""
    path = scratch_path(t.spark, "customers-by-segment")
    t.customer.hint("rebalance", "c_mktsegment").write.partitionBy("c_mktsegment").parquet(path)
    found = files.list_objects(t.spark, path).filter("size > 0 AND modificationTime IS NOT NULL")
    return found.select(F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1).alias("segment")).filter("segment <> ''").distinct()


@query("s_bundle", """
SELECT 'customer' AS name, c_custkey AS key FROM customer UNION ALL SELECT 'orders', o_orderkey FROM orders
""")
def s_bundle(t):
    path = scratch_path(t.spark, "bundle")
    files.write_bundle({"customer": t.customer, "orders": t.orders}, path)
    back = files.read_bundle(t.spark, path, ["customer", "orders"])
    keys = [("customer", "c_custkey"), ("orders", "o_orderkey")]
    a, b = (back[n].select(F.lit(n).alias("name"), F.col(k).alias("key")) for n, k in keys)
    return a.unionByName(b)


@query("s_catalog_table", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def s_catalog_table(t):
    """A table made from a schema, replaced, appended to and read back."""
    name = f"orders_{uuid.uuid4().hex}"
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    try:
        catalog.create_table(t.spark, name, rows.schema)
        catalog.write_table(rows, name, "append")
        catalog.write_table(rows.filter("o_orderstatus <> 'P'"), name, "replace")
        catalog.write_table(rows.filter("o_orderstatus = 'F'"), name, "append")
        return materialise(catalog.read_table(t.spark, name), "orders-table")
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("t_saved_result", """
SELECT o_custkey, COUNT(*) AS orders, (SELECT CAST(COUNT(DISTINCT o_custkey) AS VARCHAR) FROM orders) AS stored_rows FROM orders GROUP BY o_custkey
""")
def t_saved_result(t):
    """A result saved, refreshed twice, and read through its view, beside the row count of its statistics."""
    name = f"orders_per_customer_{uuid.uuid4().hex}"
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    try:
        for part in ("orders > 10", "orders > 5", "true"):
            version = catalog.publish(per.filter(part), name)
        stored = f"{name}__v{version}"
        catalog.analyze(t.spark, stored)
        known = t.spark.sql(f"DESCRIBE EXTENDED {stored}").filter("col_name = 'Statistics'").first()["data_type"]
        rows = catalog.read_table(t.spark, name).withColumn("stored_rows", F.regexp_extract(F.lit(known), "([0-9]+) rows", 1))
        return materialise(rows, "saved-result")
    finally:
        t.spark.sql(f"DROP VIEW IF EXISTS {name}")
        for v in catalog.versions(t.spark, name):
            t.spark.sql(f"DROP TABLE IF EXISTS {name}__v{v}")


@query("t_refreshed_result", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, YEAR(o_orderdate) AS year, {total('o_totalprice')} AS revenue,
       CASE WHEN YEAR(o_orderdate) IN (1995, 1996) THEN 2 ELSE 1 END AS written_by
FROM orders WHERE o_orderdate < DATE '1997-01-01' OR o_orderdate >= DATE '1998-01-01' GROUP BY 1, 2
""")
def t_refreshed_result(t):
    """Daily revenue by year, refreshed by its key: late orders of two years and a year that goes.

    Only the folders of the two years are written again; those of the others
    stay as the first version wrote them.
    """
    name = f"daily_by_year_{uuid.uuid4().hex}"
    day, year = F.col("o_orderdate").cast("date"), F.year("o_orderdate")
    late = year.isin(1995, 1996) & (F.col("o_orderpriority") == "1-URGENT")
    daily = lambda rows: rows.groupBy(day.alias("order_date"), year.alias("year")).agg(exact_sum("o_totalprice").alias("revenue"))
    try:
        refresh.refresh(daily(t.orders.filter(~late)), name, ["order_date"], ["year"])
        refresh.refresh(daily(t.orders.filter(year != 1997)), name, ["order_date"], ["year"])
        rows = t.spark.table(name).join(refresh.manifest(t.spark, name), "year")
        return materialise(rows.select("order_date", F.col("year").cast("bigint").alias("year"), "revenue", F.col("_version").alias("written_by")), "refreshed")
    finally:
        refresh.drop_refreshed(t.spark, name)


@query("s_person_rows", """
SELECT SPLIT_PART(c_name, '#', 1) || ' ' || SPLIT_PART(c_name, '#', 2) AS name, LOWER(c_name) || '@example.org' AS email,
       c_mktsegment AS city, n_name AS state, r_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def s_person_rows(t):
    """Customers as nested user records in an array, flattened again."""
    part = F.split("c_name", "#")
    person = F.struct(
        F.struct(part[0].alias("first"), part[1].alias("last")).alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.struct(F.col("c_mktsegment").alias("city"), F.col("n_name").alias("state"), F.col("r_name").alias("country")).alias("location"),
    )
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return payloads.person_rows(rows.select(F.array(person).alias("people")), "people")
