"""Strings, arrays, maps, JSON."""

from pyspark.sql import functions as F

from quayside.functions import nested as J, text as X
from quayside.queries.registry import query

WS = r"[\s\p{Z}]"
SQUEEZED = rf"TRIM(REGEXP_REPLACE(text, '{WS}+', ' ', 'g'))"
TITLED = """ARRAY_TO_STRING(LIST_TRANSFORM(REGEXP_EXTRACT_ALL({0}, '(\\p{{L}}+|[^\\p{{L}}]+)'),
  lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE UPPER(w[1]) END || LOWER(w[2:])), '')"""


def titled(x):
    return TITLED.format(x)


@query("x_concat", """
SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label, CONCAT_WS(' - ', c_name, n_name) AS place
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def x_concat(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        "c_custkey", F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("label"),
        F.concat_ws(" - ", "c_name", "n_name").alias("place"),
    )


@query("x_case_trim", """
SELECT c_custkey, LOWER(c_name) AS lower_name, UPPER(c_name) AS upper_name, TRIM('  ' || c_name || ' ') AS trimmed,
       LENGTH(c_name) AS name_length, UPPER(c_mktsegment[1]) || LOWER(c_mktsegment[2:]) AS capitalised
FROM customer
""")
def x_case_trim(t):
    seg = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("lower_name"), F.upper("c_name").alias("upper_name"),
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        F.length("c_name").cast("bigint").alias("name_length"),
        F.concat(F.upper(F.substring(seg, 1, 1)), F.lower(seg.substr(F.lit(2), F.length(seg)))).alias("capitalised"),
    )


@query("x_clean_name", f"""
WITH c AS (SELECT doc_id, {titled(SQUEEZED)} AS cleaned FROM documents)
SELECT doc_id, cleaned, NULLIF(SPLIT_PART(cleaned, ' ', 1), '') AS first_word, NULLIF(SPLIT_PART(cleaned, ' ', -1), '') AS last_word FROM c
""")
def x_clean_name(t):
    rows = t.documents.select("doc_id", X.clean_name("text").alias("cleaned"))
    return rows.withColumns({"first_word": X.first_word("cleaned"), "last_word": X.last_word("cleaned")})


# E-mails made of names; spaced, upper-cased or broken by segment.
EMAIL = """CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || UPPER(REPLACE(c_name, '#', '.')) || '@EXAMPLE.COM '
  WHEN 'MACHINERY' THEN REPLACE(c_name, '#', ' ') || '@example.com' WHEN 'HOUSEHOLD' THEN REPLACE(c_name, '#', '.')
  ELSE REPLACE(c_name, '#', '.') || '@shop-' || c_nationkey || '.co.in' END"""
EMAIL_RE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def email_text():
    seg, name = F.col("c_mktsegment"), F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    return (
        F.when(seg == "BUILDING", F.concat(F.lit("  "), F.upper(name), F.lit("@EXAMPLE.COM ")))
        .when(seg == "MACHINERY", F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")), F.lit("@example.com")))
        .when(seg == "HOUSEHOLD", name)
        .otherwise(F.concat(name, F.lit("@shop-"), F.col("c_nationkey").cast("string"), F.lit(".co.in")))
    )


@query("x_clean_email", f"""
WITH e AS (SELECT c_custkey, {EMAIL} AS email FROM customer), c AS (SELECT *, LOWER(TRIM(email)) AS cleaned FROM e)
SELECT c_custkey, email, cleaned, REGEXP_MATCHES(cleaned, '{EMAIL_RE}') AS is_valid, NULLIF(SPLIT_PART(cleaned, '@', 2), '') AS domain FROM c
""")
def x_clean_email(t):
    rows = t.customer.select("c_custkey", email_text().alias("email"))
    rows = rows.withColumn("cleaned", X.clean_email("email"))
    return rows.withColumns({"is_valid": X.is_email("cleaned"), "domain": X.email_domain("cleaned")})


PHONE = """CASE c_mktsegment WHEN 'BUILDING' THEN '+91-' || CAST(9000000000 + c_custkey AS VARCHAR)
  WHEN 'MACHINERY' THEN '(' || CAST(8000000000 + c_custkey AS VARCHAR) || ')' WHEN 'HOUSEHOLD' THEN CAST(c_custkey AS VARCHAR)
  ELSE '98765 ' || LPAD(CAST(c_nationkey AS VARCHAR), 5, '4') END"""


def phone_text():
    seg = F.col("c_mktsegment")
    return (
        F.when(seg == "BUILDING", F.concat(F.lit("+91-"), (F.lit(9000000000) + F.col("c_custkey")).cast("string")))
        .when(seg == "MACHINERY", F.concat(F.lit("("), (F.lit(8000000000) + F.col("c_custkey")).cast("string"), F.lit(")")))
        .when(seg == "HOUSEHOLD", F.col("c_custkey").cast("string"))
        .otherwise(F.concat(F.lit("98765 "), F.lpad(F.col("c_nationkey").cast("string"), 5, "4")))
    )


@query("x_clean_phone", f"""
WITH p AS (SELECT c_custkey, {PHONE} AS phone FROM customer), d AS (SELECT *, REGEXP_REPLACE(phone, '\\D', '', 'g') AS d FROM p),
l AS (SELECT *, CASE WHEN d LIKE '91%' AND LENGTH(d) > 10 THEN d[3:] ELSE d END AS l FROM d),
k AS (SELECT *, CASE WHEN LENGTH(l) = 10 THEN l END AS cleaned FROM l)
SELECT c_custkey, phone, cleaned, '+91 ' || cleaned[:5] || ' ' || cleaned[6:] AS shown,
       CASE WHEN LENGTH(d) = 10 THEN '+91 ' || d[:5] || ' ' || d[6:] ELSE phone END AS formatted FROM k
""")
def x_clean_phone(t):
    rows = t.customer.select("c_custkey", phone_text().alias("phone")).withColumn("cleaned", X.clean_phone("phone"))
    return rows.withColumns({"shown": X.show_phone("cleaned"), "formatted": X.format_phone("phone")})


@query("x_city", f"""
WITH a AS (SELECT c_custkey, '  flat  ' || c_custkey || ', ' || LOWER(c_mktsegment) || '  road, ' || n_name || ' , ' || r_name AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey, {titled("TRIM(REGEXP_REPLACE(address, '" + WS + "+', ' ', 'g'))")} AS cleaned FROM a)
SELECT c_custkey, cleaned, TRIM(SPLIT_PART(cleaned, ',', -2)) AS city FROM c
""")
def x_city(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    address = F.concat(
        F.lit("  flat  "), F.col("c_custkey").cast("string"), F.lit(", "), F.lower("c_mktsegment"),
        F.lit("  road, "), "n_name", F.lit(" , "), "r_name",
    )
    rows = rows.select("c_custkey", X.clean_address(address).alias("cleaned"))
    return rows.withColumn("city", X.address_city("cleaned"))


CLEAN = rf"""TRIM(REGEXP_REPLACE(REGEXP_REPLACE(REGEXP_REPLACE(text, '[^\p{{L}}\p{{N}}_\s\p{{Z}}.,!?-]', '', 'g'),
  '([!?.]){{2,}}', '\1', 'g'), '{WS}+', ' ', 'g'))"""


@query("x_clean_text", f"""
WITH c AS (SELECT doc_id, {CLEAN} AS s FROM documents), k AS (SELECT doc_id, UPPER(s[1]) || s[2:] AS cleaned FROM c)
SELECT doc_id, cleaned, LENGTH(cleaned) AS text_length,
       CAST(LEN(LIST_FILTER(STRING_SPLIT(cleaned, ' '), lambda w: w <> '')) AS BIGINT) AS word_count FROM k
""")
def x_clean_text(t):
    rows = t.documents.select("doc_id", X.clean_comment("text").alias("cleaned"))
    return rows.withColumns({
        "text_length": F.length("cleaned").cast("bigint"), "word_count": X.word_count("cleaned"),
    })


@query("x_strip_special", rf"""
SELECT doc_id, TRIM(REGEXP_REPLACE(REGEXP_REPLACE(text, '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', ' ', 'g'), '{WS}+', ' ', 'g')) AS stripped FROM documents
""")
def x_strip_special(t):
    return t.documents.select("doc_id", X.strip_special("text").alias("stripped"))


@query("x_text_features", rf"""
WITH w AS (SELECT doc_id, text, LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(text, '{WS}+'), lambda w: w <> '') AS words FROM documents)
SELECT doc_id, LENGTH(text) AS text_length, CAST(LEN(words) AS BIGINT) AS text_word_count, words[1] AS text_first_word,
       CASE WHEN CONTAINS(LOWER(text), 'the') THEN 1 ELSE 0 END AS text_has_the FROM w
""")
def x_text_features(t):
    from quayside.plans.features import text_features

    return text_features(t.documents.select("doc_id", "text"), "text", "the").drop("text")


@query("x_zfill", """
SELECT c_custkey, CASE WHEN LENGTH(CAST(c_custkey AS VARCHAR)) < 10 THEN LPAD(CAST(c_custkey AS VARCHAR), 10, '0') ELSE CAST(c_custkey AS VARCHAR) END AS padded,
       CASE WHEN LENGTH(c_name) < 10 THEN LPAD(c_name, 10, '0') ELSE c_name END AS padded_name,
       REPEAT('  ', c_nationkey) || c_mktsegment AS indented FROM customer
""")
def x_zfill(t):
    return t.customer.select(
        "c_custkey", X.zero_pad("c_custkey").alias("padded"), X.zero_pad("c_name").alias("padded_name"),
        X.indent("c_mktsegment", F.col("c_nationkey")).alias("indented"),
    )


@query("x_clean_ids", """
WITH i AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE ' ' || LOWER(c_name) || ' ' END AS raw FROM customer)
SELECT c_custkey, UPPER(TRIM(raw)) AS id FROM i WHERE TRIM(raw) <> ''
""")
def x_clean_ids(t):
    raw = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")))
    return t.customer.select("c_custkey", X.clean_id(raw).alias("id")).filter(F.col("id") != "")


@query("x_array_ops", """
SELECT vec_id, embedding[1] AS first, embedding[-1] AS last, embedding[10000] AS beyond,
       CAST(LEN(embedding) AS BIGINT) AS size, LIST_SUM(LIST_TRANSFORM(embedding[1:3], lambda x: ROUND(CAST(x AS DOUBLE), 4))) AS head_sum,
       CAST(LEN(LIST_APPEND(embedding, CAST(label AS FLOAT))) AS BIGINT) AS appended_size, LIST_APPEND(embedding, CAST(label AS FLOAT))[-1] AS appended,
       ARRAY_TO_STRING(LIST_TRANSFORM(embedding[1:3], lambda x: CAST(FLOOR(x * 1000) AS BIGINT)), ',') AS joined
FROM embeddings
""")
def x_array_ops(t):
    e = F.col("embedding")
    head = F.slice(e, 1, 3)
    longer = F.array_append(e, F.col("label").cast("float"))
    return t.embeddings.select(
        "vec_id", F.get(e, F.lit(0)).alias("first"), F.try_element_at(e, F.lit(-1)).alias("last"),
        F.get(e, F.lit(9999)).alias("beyond"), F.size(e).cast("bigint").alias("size"),
        F.aggregate(F.transform(head, lambda x: F.round(x.cast("double"), 4)), F.lit(0.0), lambda a, x: a + x).alias("head_sum"),
        F.size(longer).cast("bigint").alias("appended_size"), F.try_element_at(longer, F.lit(-1)).alias("appended"),
        J.joined(F.transform(head, lambda x: F.floor(x.cast("double") * 1000).cast("string"))).alias("joined"),
    )


@query("x_explode", """
SELECT vec_id, UNNEST(embedding) AS element FROM embeddings
""")
def x_explode(t):
    return t.embeddings.select("vec_id", F.explode("embedding").alias("element"))


@query("x_map_ops", """
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, CAST(3 AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS missing FROM customer
""")
def x_map_ops(t):
    zipped = J.zip_to_map(F.array(F.lit("name"), F.lit("segment")), F.array("c_name", "c_mktsegment"))
    rows = t.customer.select("c_custkey", J.with_entry(zipped, "nation", F.col("c_nationkey").cast("string")).alias("m"))
    return rows.select(
        "c_custkey", F.col("m")["name"].alias("name"), F.col("m")["segment"].alias("segment"),
        F.size("m").cast("bigint").alias("size"), F.try_element_at("m", F.lit("phone")).alias("missing"),
    )
