"""Secrets: fixed patterns, and strings that look random to a pair of character Markov models.

DataFrame operations only. One chain is counted over strings that the fixed
patterns label as secrets, the other over ordinary identifiers; a candidate is
added where the log-likelihood ratio of the two favours the random chain.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.spans import Kind, digest, matches
from quayside.llm.text import hash_sample
from quayside.session import materialise

_KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
KINDS = [
    Kind("assign", _KEY + r"[A-Za-z0-9+/_.=-]++", r"(?i)password|passwd|secret|token|api_?key"),
    Kind("access", r"AKIA[A-Z0-9]++", "AKIA"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", "[0-9a-f]{24}"),
    Kind("random", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+", "[A-Za-z0-9+/_-]{16}"),
]
NAMES = [k.name for k in KINDS]
BASE = 3
#: Labelled samples the chains are fitted on: about so many strings of each label at most, chosen by hash.
SAMPLE = 20_000
#: About so many documents, chosen by hash, in which ordinary identifiers are looked for.
SAMPLE_DOCS = 5_000
#: The signs told apart; every other sign counts as one more.
SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-.="
#: Transitions that the overall share of a sign is worth.
PRIOR_COUNT = 20
#: Least mean and total log-likelihood ratio, in nats.
LEAST_MEAN, LEAST_TOTAL = 0.25, 8.0


def value() -> Column:
    """What is secret in a match: the assigned value, else the whole match."""
    return F.when(F.col("kind") == 0, F.regexp_replace("hit", "^" + _KEY, "")).otherwise(F.col("hit"))


def valid() -> Column:
    size = F.char_length("value")
    return (
        F.when(F.col("kind") == 0, size >= 6).when(F.col("kind") == 1, size >= 20).when(F.col("kind") == 2, size >= 24)
        .when(F.col("kind") == 3, True).otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """Matches of all kinds with `value` and `valid`; a text without any has one row with a null kind."""
    found = matches(docs, KINDS).withColumn("value", value())
    return found.withColumn("valid", valid())


def _pairs(text: Column) -> Column:
    """Numbers of the neighbouring sign pairs of a string, each first * width + second."""
    width = len(SIGNS) + 1
    n = F.char_length(text)
    code = lambda at: F.instr(F.lit(SIGNS), F.substring(text, at, F.lit(1)))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: code(i) * width + code(i + 1))).otherwise(
        F.array().cast("array<int>"))


def chain_ratios(samples: DataFrame) -> list[float]:
    """Log ratio of each transition, random over ordinary, from labelled strings (value, random).

    A chain's transition shares are drawn towards the overall share of the
    second sign, with the weight of `PRIOR_COUNT` transitions, so a sign that
    ordinary identifiers rarely have is unlikely after any other. Without
    samples of a label its chain is uniform. One entry per pair of signs.
    """
    width = len(SIGNS) + 1
    rows = samples.select("random", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("random", "pair").count().collect()
    seen = {True: [0] * width**2, False: [0] * width**2}
    for r in rows:  # at most two rows per pair of signs
        seen[r["random"]][r["pair"]] = r["count"]
    logs = {}
    for label, counts in seen.items():
        second = [0.5 + sum(counts[b::width]) for b in range(width)]
        share = [x / sum(second) for x in second]
        first = [sum(counts[a * width:(a + 1) * width]) for a in range(width)]
        logs[label] = [
            math.log((c + PRIOR_COUNT * share[k % width]) / (first[k // width] + PRIOR_COUNT)) for k, c in enumerate(counts)]
    return [a - b for a, b in zip(logs[True], logs[False])]


def labelled_strings(docs: DataFrame, found: DataFrame) -> DataFrame:
    """value, random: secrets that the fixed patterns found, and long words that stand alone in documents chosen by hash."""
    secret = hash_sample(found.where((F.col("kind") < BASE) & F.col("valid")).select("value").distinct(), "value", SAMPLE)
    some = hash_sample(docs.select("doc_id", "text"), "doc_id", SAMPLE_DOCS)
    word = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?<!\S)[A-Za-z_-]{8,40}+(?!\S)"), 0))
    plain = hash_sample(some.select(word.alias("value")).distinct(), "value", SAMPLE)
    return secret.withColumn("random", F.lit(True)).unionByName(plain.withColumn("random", F.lit(False)))


def scored(docs: DataFrame) -> DataFrame:
    """Candidates with `ratio` (mean log-likelihood ratio per transition) and `kept`."""
    found = materialise(candidates(docs), "secrets")
    table = F.from_json(F.lit(json.dumps(chain_ratios(labelled_strings(docs, found)))), "array<double>")
    total = F.aggregate(_pairs(F.col("value")), F.lit(0.0), lambda a, p: a + F.get(table, p))
    found = found.withColumn("total", F.when(F.col("valid"), total))
    found = found.withColumn("ratio", F.col("total") / F.greatest(F.char_length("value") - 1, F.lit(1)))
    random = (F.col("ratio") >= LEAST_MEAN) & (F.col("total") >= LEAST_TOTAL)
    return found.withColumn("kept", F.col("valid") & ((F.col("kind") < BASE) | random))


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per kept span: doc_id, kind, start, end, value, ratio."""
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("kind") + 1)
    return scored(docs).where("kept").select("doc_id", name.alias("kind"), "start", "end", "value", "ratio")


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Base spans stay whatever their ratio; a random span may lie inside one.
    Null and empty texts have no spans and the hash of the empty string;
    repeated rows and null ids each come back; an empty table gives no rows.
    """
    return digest(scored(docs), NAMES, BASE, F.col("kept"), by_start=True)
