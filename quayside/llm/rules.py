"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow boosted trees are grown on the statistics of a bounded labelled
sample; every path from a root becomes a conjunctive rule; an L1-penalised
logistic regression keeps the rules that matter. What remains is compiled into
one Spark column expression, so scoring is a projection over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import hash_sample, remainder

#: About so many labelled rows at most are fitted, chosen by hash of their id.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST_LEAF = 40, 3, 32, 0.3, 10
#: L1 penalty per row and steps of the proximal descent.
PENALTY, STEPS = 0.002, 600
#: Signs counted one by one, and those counted together.
SIGNS = {"shouts": "!", "asks": "?", "bars": "|", "stops": ".", "commas": ",", "blanks": " "}
SYMBOLS = r"[%$&#*|!@<>{}\[\]=_~^\\/]+"


def measures(text: Column) -> dict[str, Column]:
    """Counts of a whole text, each made by one pass or two."""
    n = F.char_length(text)
    words = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    lines = F.split(text, "\n")
    out = {
        "chars": n, "words": F.size(words), "unlike_words": F.size(F.array_distinct(words)),
        "lines": F.size(lines), "unlike_lines": F.size(F.array_distinct(lines)),
        "symbols": n - F.char_length(F.regexp_replace(text, SYMBOLS, "")),
        "capitals": F.regexp_count(text, F.lit(r"\p{Lu}{2,}")), "digits": F.regexp_count(text, F.lit("[0-9]+")),
    }
    for name, sign in SIGNS.items():
        out[name] = n - F.char_length(F.replace(text, F.lit(sign), F.lit("")))
    return out


def statistics(m: dict[str, Column]) -> dict[str, Column]:
    """Statistics from the counts, each a bounded double; all 0 for an empty text."""
    n, n_words = m["chars"], m["words"]
    per = lambda count, of: F.when((n > 0) & (of > 0), count / of).otherwise(F.lit(0.0))
    return {
        "chars_log": F.log1p(n.cast("double")),
        "word_length": F.least(per(n, n_words), F.lit(100.0)),
        "symbols": per(m["symbols"], n),
        "marks": per(m["shouts"] + m["asks"], n_words),
        "bars": per(m["bars"], n_words),
        "stops": per(m["stops"], n_words),
        "commas": per(m["commas"], n_words),
        "blanks": per(m["blanks"], n),
        "capitals": per(m["capitals"], n_words),
        "digits": per(m["digits"], n_words),
        "line_words": F.least(per(n_words, m["lines"]), F.lit(1000.0)),
        "same_lines": per(m["lines"] - m["unlike_lines"], m["lines"]),
        "same_words": per(n_words - m["unlike_words"], n_words),
    }


NAMES = [
    "chars_log", "word_length", "symbols", "marks", "bars", "stops", "commas", "blanks", "capitals", "digits",
    "line_words", "same_lines", "same_words",
]

#: A condition: statistic, threshold, True for "above".
Condition = tuple[int, float, bool]


@dataclass(frozen=True)
class RuleModel:
    """Intercept and weighted rules; a rule is a tuple of conditions that must all hold."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def column(self, stats: list[Column]) -> Column:
        """The score, 0 to 1, as one expression over the statistics' columns."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for at, edge, above in conditions:
                holds = holds & ((stats[at] > edge) if above else (stats[at] <= edge))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = self.intercept + sum((w * holding(x, c) for c, w in self.rules), np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def holding(x: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for at, edge, above in conditions:
        out &= (x[:, at] > edge) if above else (x[:, at] <= edge)
    return out


def best_split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, edges: list[np.ndarray]):
    """(gain, statistic, threshold) of the split that gains most, or None."""
    g, h = grad.sum(), hess.sum()
    best = None
    for at, cuts in enumerate(edges):
        if not len(cuts):
            continue
        place = np.searchsorted(cuts, x[:, at], side="left")
        size = np.bincount(place, minlength=len(cuts) + 1).cumsum()[:-1]
        gl = np.bincount(place, grad, len(cuts) + 1).cumsum()[:-1]
        hl = np.bincount(place, hess, len(cuts) + 1).cumsum()[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain[(size < LEAST_LEAF) | (len(x) - size < LEAST_LEAF)] = -1
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = gain[k], at, float(cuts[k])
    return best


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, edges: list[np.ndarray]) -> list[tuple[tuple[Condition, ...], float, bool]]:
    """All paths of one tree: (conditions, leaf value, whether it is a leaf)."""
    paths, open_nodes = [], [((), np.arange(len(x)))]
    while open_nodes:
        conditions, rows = open_nodes.pop()
        split = best_split(x[rows], grad[rows], hess[rows], edges) if len(conditions) < DEPTH else None
        paths.append((conditions, float(-grad[rows].sum() / (hess[rows].sum() + 1)), split is None))
        if split:
            _, at, edge = split
            low = x[rows, at] <= edge
            open_nodes += [((*conditions, (at, edge, False)), rows[low]), ((*conditions, (at, edge, True)), rows[~low])]
    return paths


def lasso_logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient; the intercept has no penalty."""
    n, m = z.shape
    step = 4.0 / (np.linalg.norm(np.c_[np.ones(n), z], 2) ** 2 / n)
    w = look = np.zeros(m + 1)
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(look[0] + z @ look[1:], -30, 30)))
        new = look - step * np.r_[(p - y).mean(), z.T @ (p - y) / n]
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * PENALTY, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, w = new + (before - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Trees, their paths as rules, sparse weights. Without rows of both labels the score is the smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return RuleModel(start, ())
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    rules: dict[tuple[Condition, ...], None] = {}
    f = np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        for conditions, value, leaf in grow(x, p - y, p * (1 - p), edges):
            if conditions:
                rules.setdefault(tuple(sorted(conditions)))
            if leaf:
                f[holding(x, conditions)] += RATE * value
    unlike: dict[bytes, tuple[Condition, ...]] = {}
    for r in rules:  # of rules that hold for the same rows, the shortest
        key = holding(x, r).tobytes()
        if key not in unlike or len(r) < len(unlike[key]):
            unlike[key] = r
    kept = list(unlike.values())
    if not kept:
        return RuleModel(start, ())
    b, w = lasso_logistic(np.stack([holding(x, r) for r in kept], 1).astype(float), y.astype(float))
    return RuleModel(b, tuple((r, float(v)) for r, v in zip(kept, w) if abs(v) > 1e-6))


def labelled(labels: DataFrame, name: str, held_out: tuple[int, int]) -> DataFrame:
    """doc_id, y: one row per id with a label 0 or 1 outside the held-out fold; of unlike labels the more frequent, 1 at a tie."""
    parts, out = held_out
    y = labels[name].cast("int")
    own = labels.select(labels["doc_id"].cast("long").alias("doc_id"), y.alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL")
    own = own.where(remainder(F.col("doc_id"), parts) != out)
    return own.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))


def _with_stats(docs: DataFrame) -> DataFrame:
    """`docs` with the statistics as one struct column `__stats`.

    The counts are a projection of their own, in which Spark makes a repeated
    part once. Unfolding a one-element array then keeps the optimizer from
    writing each statistic anew at every place where a rule names it.
    """
    own = docs.withColumn("__text", F.coalesce(docs["text"], F.lit("")))
    counts = measures(F.col("__text"))
    own = own.select(*[own[c] for c in docs.columns], *[c.alias(f"__{k}") for k, c in counts.items()])
    stats = statistics({k: F.col(f"__{k}") for k in counts})
    return own.select(*[own[c] for c in docs.columns], F.explode(F.array(F.struct(*[stats[n].alias(n) for n in NAMES]))).alias("__stats"))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of the whole text; null texts count as empty."""
    own = _with_stats(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")))
    return own.select("doc_id", "__stats.*")


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int], name: str = "quality") -> RuleModel:
    """Fit on about SAMPLE labelled documents at most; only their statistics come to the driver."""
    sample = hash_sample(labelled(labels, name, held_out), "doc_id", SAMPLE)
    # at most about SAMPLE rows of two numbers, so the documents need not move
    rows = with_statistics(docs.join(F.broadcast(sample.select(F.col("doc_id").alias("__id"))), docs["doc_id"] == F.col("__id"), "left_semi"))
    got = rows.join(F.broadcast(sample), "doc_id").orderBy("doc_id", *NAMES).toPandas()
    return fit(got[NAMES].to_numpy(float), got["y"].to_numpy(int))


def score(docs: DataFrame, model: RuleModel, held_out: tuple[int, int]) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5).

    Null and empty texts are scored with all statistics 0. A null id counts as
    the empty text in the fold. Repeated rows each come back; further columns
    are ignored; an empty table gives no rows.
    """
    parts, out = held_out
    own = with_statistics(docs)
    scored = own.select(
        "doc_id", (remainder(F.col("doc_id"), parts) == out).alias("held_out"),
        model.column([F.col(n) for n in NAMES]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The rows of `docs`, all columns, whose text the model accepts (score of at least 0.5)."""
    own = _with_stats(docs)
    return own.where(model.column([F.col(f"__stats.{n}") for n in NAMES]) >= 0.5).drop("__stats")
