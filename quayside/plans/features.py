"""Feature building on purchase records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quayside.functions import dates, numbers, text
from quayside.functions.exact import number
from quayside.operators.encoding import frequency_encode, label_encode, one_hot, quoted
from quayside.operators.ordered import MIN_ROWS, with_neighbours
from quayside.operators.series import lag_columns

STATS = [
    "purchase_count", "total_spent", "avg_purchase", "max_purchase", "min_purchase", "purchase_std", "purchase_range", "purchase_cv",
]
LAGS = ["prev_value", "prev_2_value", "rolling_avg_3", "days_since_last"]


def stat_aggregates(df: DataFrame, amount: str) -> dict:
    """count, sum, mean, max, min and std (n-1) of the purchases."""
    x = F.col(amount).cast("double")
    return {
        "purchase_count": F.count(F.lit(1)),
        "total_spent": F.sum(number(df, amount)).cast("double"),
        "avg_purchase": F.avg(number(df, amount)).cast("double"),
        "max_purchase": F.max(x),
        "min_purchase": F.min(x),
        "purchase_std": F.stddev_samp(x),
    }


def spread_columns() -> dict:
    return {
        "purchase_range": F.col("max_purchase") - F.col("min_purchase"),
        "purchase_cv": F.try_divide("purchase_std", "avg_purchase"),
    }


def purchase_stats(df: DataFrame, key: str, amount: str, *first) -> DataFrame:
    """count, sum, mean, max, min, std (n-1), range and variation per customer."""
    out = df.groupBy(key).agg(*[a.alias(n) for n, a in stat_aggregates(df, amount).items()], *first)
    return out.withColumns(spread_columns())


def date_features(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(dates.calendar_features(column))


def numeric_features(df: DataFrame, amount: str, base: str, bands) -> DataFrame:
    """Band, log, root, square, ratio to and product with `base`."""
    edges, labels = bands
    a, b = F.col(amount).cast("double"), F.col(base).cast("double")
    return df.withColumns({
        f"{base}_band": numbers.bins(base, edges, labels),
        f"{amount}_log": F.log1p(a),
        f"{amount}_sqrt": F.sqrt(a),
        f"{amount}_squared": F.pow(a, F.lit(2.0)),
        f"{amount}_to_{base}_ratio": F.try_divide(a, b),
        f"{base}_{amount}_interaction": a * b,
    })


def text_features(df: DataFrame, name: str, needle: str) -> DataFrame:
    """Length, word count, first word, and whether `needle` occurs (case ignored)."""
    return df.withColumns({
        f"{name}_length": F.length(name).cast("bigint"),
        f"{name}_word_count": text.word_count(name),
        f"{name}_first_word": text.first_word(name),
        f"{name}_has_{needle.lower()}": text.contains_ci(name, needle).cast("int"),
    })


def interaction_features(df: DataFrame, groups: Sequence[tuple[str, str]], left: str, right: str) -> DataFrame:
    """Combined text keys, a product, and a ratio guarded by + 1."""
    combined = {f"{a}_{b}": F.concat(F.col(a), F.lit("_"), F.col(b)) for a, b in groups}
    x, y = F.col(left).cast("double"), F.col(right).cast("double")
    return df.withColumns(combined | {
        f"{left}_{right}_product": x * y,
        f"{left}_{right}_ratio": F.try_divide(x, y + 1),
    })


def all_features(
    df: DataFrame, key: str, row_id: str, time: str, amount: str, base: str, name: str,
    category: str, group: str, labels: dict, bands, needle: str,
    levels: Sequence | None = None, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Date, numeric, category, aggregate, text, interaction and time features in that order.

    What needs other rows comes first, on the given columns: shares by group,
    then the customer's statistics and the ordered looks back, which share one
    exchange by customer (hot customers in parts). The wide columns are made
    from a row alone and never move.
    """
    given = df.columns
    share = f"{group}_frequency"
    rows = frequency_encode(df, group, share)
    stats = {n: a for n, a in stat_aggregates(df, amount).items() if n != "total_spent" and n != "avg_purchase"}
    stats |= {"total_spent": F.sum(number(df, amount)), "_known": F.count(amount)}
    rows = with_neighbours(
        rows, [time, row_id], lag_columns(df, time, amount), [key], before=2, totals=stats, min_rows=min_rows)
    rows = rows.withColumns({
        "total_spent": F.col("total_spent").cast("double"),
        "avg_purchase": F.try_divide(F.col("total_spent").cast("double"), F.col("_known")),
    }).withColumns(spread_columns())
    out = numeric_features(date_features(rows, time), amount, base, bands)
    own = [c for c in out.columns if c not in rows.columns]
    out = one_hot(out.withColumn("_category", F.col(category)), "_category", prefix="category", values=levels)
    own += [c for c in out.columns if c not in rows.columns and c not in own]
    out = label_encode(out, group, labels, f"{group}_encoded")
    own += [f"{group}_encoded", share, *STATS]
    before = set(out.columns)
    out = interaction_features(text_features(out, name, needle), [(group, category)], base, amount)
    own += [c for c in out.columns if c not in before]
    return out.select(*[quoted(c) for c in [*given, *own, *LAGS]])
