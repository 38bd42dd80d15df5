"""The registered queries of this package; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import (
    boosted_quality, bpe, decontaminate, gru, jaccard_join, pages, pii, pivot_clusters, prefix_trie, recipes, rules, secrets, toxicity,
)
from quayside.session import tune
from quayside.tables import Tables

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame`, beside the SQL for the same rows where there is one."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(Tables(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        LLM_QUERIES[name] = run
        if sql:
            LLM_ORACLES[name] = sql.strip()
        return fn

    return wrap


@query("op1_bpe")
def op1_bpe(t: Tables) -> DataFrame:
    return bpe.encode_decode(t.documents, public_tokenizers.path("word_bpe_49k.json"))


#: Held-out folds: crc32 of the id modulo the first, equal to the second.
QUALITY_FOLD = (3, 1)
SCORING_FOLD = (10, 0)
TOXICITY_FOLD = (5, 0)


@query("op3_rules")
def op3_rules(t: Tables) -> DataFrame:
    model = rules.train(t.documents, t.labels, QUALITY_FOLD)
    return rules.score(t.documents, model, QUALITY_FOLD)


@query("op4_simhash")
def op4_simhash(t: Tables) -> DataFrame:
    return decontaminate.leaks(t.documents, t.benchmark)


@query("op5_gru")
def op5_gru(t: Tables) -> DataFrame:
    return gru.score(t.documents, SCORING_FOLD)


@query("op8_token_groups")
def op8_token_groups(t: Tables) -> DataFrame:
    return jaccard_join.near_groups(t.documents)


@query("op10_chunk_recipes", """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)""")
def op10_chunk_recipes(t: Tables) -> DataFrame:
    return recipes.copies(t.documents)


@query("op6_pii")
def op6_pii(t: Tables) -> DataFrame:
    return pii.personal_digest(t.documents)


@query("op9_secrets")
def op9_secrets(t: Tables) -> DataFrame:
    return secrets.secret_digest(t.documents)


@query("op2_string_kernel")
def op2_string_kernel(t: Tables) -> DataFrame:
    model = toxicity.train(t.documents, t.labels, TOXICITY_FOLD)
    return toxicity.score(t.documents, model, TOXICITY_FOLD)


@query("op7_page_tree")
def op7_page_tree(t: Tables) -> DataFrame:
    return pages.main_text(t.pages, pages.train(t.pages))


#: crc32 of the decimal id, bit by bit: DuckDB has no such function.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::BIGINT * (xor(a, b) & 1))), 4294967295::BIGINT)"""


@query("op11_prefix_trie", f"""
WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS k FROM raw),
c AS (SELECT conv_id, {CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM raw)),
mixed AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.k <= c.h
  UNION ALL SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS depth FROM mixed),
p AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM placed UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY depth, path),
linked AS (
  SELECT n.*, up.path AS up FROM node n LEFT JOIN p up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
full_node AS (
  SELECT n.*, coalesce(kids.n_children, 0) AS n_children, parent.conv_id AS parent_conv_id
  FROM linked n LEFT JOIN kids USING (depth, path) LEFT JOIN node parent ON parent.depth = n.depth - 1 AND parent.path = n.up),
below AS (
  SELECT a.depth, a.path, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
  FROM full_node u JOIN p a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.depth, a.path),
deepest AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
ended AS (
  SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM p JOIN deepest USING (conv_id, depth) GROUP BY depth, path)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, below.n_leaves, below.saved_tokens,
       sha256(coalesce(ended.ids, '')) AS ends_sha256
FROM full_node n JOIN below USING (depth, path) LEFT JOIN ended USING (depth, path)""")
def op11_prefix_trie(t: Tables) -> DataFrame:
    return prefix_trie.prefix_trie(t.conversations)


def _rounds(count: int) -> str:
    """CTEs near_0, centre_1, near_1 ... of plain rounds: all distances, floors of exact means, empty ones stay."""
    out = []
    for k in range(count + 1):
        out.append(f"""near_{k} AS MATERIALIZED (
  SELECT r, vec_id, v, c, d FROM (
    SELECT r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d,
           row_number() OVER (PARTITION BY r ORDER BY d, c) AS o FROM kept, centre_{k} m) WHERE o = 1)""")
        if k < count:
            out.append(f"""centre_{k + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(moved.v, m.v) AS v FROM centre_{k} m LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near_{k}) GROUP BY c, i) GROUP BY c) moved USING (c))""")
    return ",\n".join(out)


@query("op12_pivot_clusters", f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) AS r, vec_id, v FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
centre_0 AS (SELECT (r - 1)::INTEGER AS c, v FROM kept WHERE r <= 8),
{_rounds(10)}
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM near_10 JOIN centre_10 m USING (c)""")
def op12_pivot_clusters(t: Tables) -> DataFrame:
    return pivot_clusters.cluster(t.embeddings)


@query("op13_boosted_quality")
def op13_boosted_quality(t: Tables) -> DataFrame:
    return boosted_quality.judge(t.documents, boosted_quality.train(t.documents, t.labels))
