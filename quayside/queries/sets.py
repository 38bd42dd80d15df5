"""Set operations, deduplication, recursion."""

from pyspark.sql import functions as F

from quayside.operators import dedup as D, hierarchy
from quayside.queries.registry import query
from quayside.queries.sqltext import money


@query("u_union_all", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL AS origin FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier
""")
def u_union_all(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.lit("supplier").alias("origin"),
    )
    return a.unionByName(b, allowMissingColumns=True)


def buyers(t, status):
    return t.orders.filter(F.col("o_orderstatus") == status).select("o_custkey")


@query("u_intersect", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def u_intersect(t):
    return buyers(t, "F").intersect(buyers(t, "P"))


@query("u_union", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def u_union(t):
    return buyers(t, "F").union(buyers(t, "P")).distinct()


@query("u_except", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def u_except(t):
    return buyers(t, "F").subtract(buyers(t, "P"))


@query("u_dedup_exact", """
SELECT doc_id, source, lang, n_chars FROM documents
QUALIFY ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def u_dedup_exact(t):
    return D.keep_one(t.documents, ["text"], "doc_id").select("doc_id", "source", "lang", "n_chars")


@query("u_dedup_last", """
SELECT doc_id, lang FROM documents QUALIFY ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1
""")
def u_dedup_last(t):
    return D.keep_one(t.documents, ["text"], "doc_id", keep="last").select("doc_id", "lang")


@query("u_dedup_none", """
SELECT doc_id, lang FROM documents QUALIFY COUNT(*) OVER (PARTITION BY text) = 1
""")
def u_dedup_none(t):
    return D.keep_one(t.documents, ["text"], "doc_id", keep="none").select("doc_id", "lang")


@query("u_dedup_subset", """
SELECT event_id, user_id, event_type, ts, value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
""")
def u_dedup_subset(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts", "value")
    return D.distinct_by(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("u_dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def u_dedup_rows(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query("u_dedup_ci", """
SELECT doc_id, lang, source FROM documents QUALIFY ROW_NUMBER() OVER (PARTITION BY LOWER(text) ORDER BY doc_id) = 1
""")
def u_dedup_ci(t):
    return D.keep_one(t.documents, [F.lower("text")], "doc_id").select("doc_id", "lang", "source")


@query("u_name_variants", """
WITH n AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN UPPER(p_name) ELSE ' ' || p_name END AS name FROM part)
SELECT p_partkey, p_brand, name FROM n WHERE p_brand IN (
  SELECT p_brand FROM n GROUP BY p_brand HAVING COUNT(DISTINCT LOWER(TRIM(name))) > 1)
""")
def u_name_variants(t):
    name = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.concat(F.lit(" "), F.col("p_name")))
    rows = t.part.select("p_partkey", "p_brand", name.alias("name"))
    return D.name_variants(rows, "p_brand", "name")


@query("u_dup_profile", """
SELECT 'exact' AS kind, COUNT(*) - COUNT(DISTINCT text) AS duplicates FROM documents
UNION ALL SELECT 'source', COUNT(*) - COUNT(DISTINCT source) FROM documents
UNION ALL SELECT 'source and language', COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT source, lang FROM documents)) FROM documents
""")
def u_dup_profile(t):
    return D.duplicate_profile(
        t.documents, {"exact": ["text"], "source": ["source"], "source and language": ["source", "lang"]}
    )


@query("u_dup_members", """
SELECT doc_id, source, lang FROM documents QUALIFY COUNT(*) OVER (PARTITION BY text) > 1
""")
def u_dup_members(t):
    return D.repeated(t.documents, ["text"]).select("doc_id", "source", "lang")


@query("u_recursive_tree", """
WITH RECURSIVE nodes AS (
  SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent, r_name AS name FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
tree AS (
  SELECT id, name, name AS full_path, 0 AS level FROM nodes WHERE parent IS NULL
  UNION ALL SELECT c.id, c.name, t.full_path || ' > ' || c.name, t.level + 1 FROM nodes c JOIN tree t ON c.parent = t.id)
SELECT id, REPEAT('  ', level) || name AS indented_name, full_path, CAST(level AS BIGINT) AS level FROM tree
""")
def u_recursive_tree(t):
    key = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    nodes = t.region.select(
        key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name")
    ).unionByName(t.nation.select(
        key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent"), F.col("n_name").alias("name")
    )).unionByName(t.customer.select(
        key("c", "c_custkey").alias("id"), key("n", "c_nationkey").alias("parent"), F.col("c_name").alias("name")
    ))
    return hierarchy.tree(nodes, "id", "parent", "name")


@query("u_recursive_sql", """
SELECT 'r' || r_regionkey AS id, 0 AS level FROM region UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation
UNION ALL SELECT 'c' || c_custkey, 2 FROM customer
""")
def u_recursive_sql(t):
    """The same tree by a recursive common table expression."""
    t.register("region", "nation", "customer")
    return t.spark.sql("""
        WITH RECURSIVE nodes AS (
          SELECT concat('r', r_regionkey) AS id, CAST(NULL AS STRING) AS parent FROM region
          UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey) FROM nation
          UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer),
        tree(id, level) AS (
          SELECT id, 0 FROM nodes WHERE parent IS NULL
          UNION ALL SELECT c.id, t.level + 1 FROM nodes c JOIN tree t ON c.parent = t.id)
        SELECT id, level FROM tree LIMIT ALL""")


@query("u_cte_equiv", f"""
WITH h AS (SELECT o_custkey, SUM({money('o_totalprice')}) AS s FROM orders WHERE o_orderstatus = 'F'
  GROUP BY o_custkey HAVING SUM({money('o_totalprice')}) > 1000000)
SELECT c_custkey, c_name, CAST(s AS DOUBLE) AS total_spent FROM h JOIN customer ON o_custkey = c_custkey
""")
def u_cte_equiv(t):
    """Named step or nested call: the optimizer sees one plan."""
    high = (
        t.orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")).filter(F.col("s") > 1000000)
    )
    return high.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", F.col("s").cast("double").alias("total_spent")
    )
