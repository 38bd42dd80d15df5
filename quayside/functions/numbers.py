"""Parsing, banding, business measures and number formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Amount suffixes, and the words read as booleans.
AMOUNT_SUFFIXES = {"K": 1_000.0, "M": 1_000_000.0}
TRUE_WORDS = ("Yes", "yes", "YES", "True", "true", "TRUE", "1")
FALSE_WORDS = ("No", "no", "NO", "False", "false", "FALSE", "0")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_amount(c, currency: str = "₹") -> Column:
    """'₹1,20,000', '1.5M', '800K' -> double; anything else null."""
    text = F.trim(F.regexp_replace(_c(c).cast("string"), f"[{currency},]", ""))
    out = F
    for suffix, factor in AMOUNT_SUFFIXES.items():
        head = F.regexp_replace(text, f"{suffix}$", "")
        out = out.when(text.endswith(suffix), head.try_cast("double") * factor)
    return out.otherwise(text.try_cast("double"))


def parse_bool(c) -> Column:
    text = _c(c).cast("string")
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def to_number(c, dtype: str = "double") -> Column:
    """Null where the text is no number."""
    return _c(c).try_cast(dtype)


def bins(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (edge, next edge]; null outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    c, out = _c(c), F
    for lo, hi, label in zip(edges, edges[1:], labels):
        out = out.when((c > lo) & (c <= hi), label)
    return out


def tiers(c, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """Bands by upper limit: below the first limit the first label, past all the last."""
    c, out = _c(c), F
    for limit, label in zip(limits, labels):
        out = out.when(c < limit, label)
    return out.otherwise(labels[-1])


def safe_divide(a, b) -> Column:
    """Null where the divisor is 0."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def revenue(price, quantity) -> Column:
    return _c(price).cast("double") * _c(quantity).cast("int")


def profit(rev, cost) -> Column:
    return _c(rev).cast("double") - _c(cost).cast("double")


def profit_margin(rev, cost) -> Column:
    """Share of revenue, 0 where there is none."""
    r = _c(rev).cast("double")
    return F.when(r == 0, 0.0).otherwise(F.try_divide(profit(r, cost), r))


def roi(investment, returns) -> Column:
    i = _c(investment).cast("double")
    return F.when(i == 0, 0.0).otherwise(F.try_divide(_c(returns) - i, i) * 100)


def discount(price, percent) -> Column:
    """struct<price, amount>; `percent` counts to 100."""
    amount = _c(price) * (_c(percent) / 100)
    return F.struct((_c(price) - amount).alias("price"), amount.alias("amount"))


def tax(amount, rate) -> Column:
    """struct<total, amount>; `rate` counts to 1."""
    added = _c(amount) * _c(rate)
    return F.struct((_c(amount) + added).alias("total"), added.alias("amount"))


def growth_rate(old, new) -> Column:
    """Percent; 0 -> 0 is 0, 0 -> x is infinite."""
    a, b = _c(old).cast("double"), _c(new).cast("double")
    rest = F.try_divide(b - a, a) * 100
    return F.when((a == 0) & (b == 0), 0.0).when(a == 0, float("inf")).otherwise(rest)


def tier_discount(tier, rates: dict[str, float], default: float) -> Column:
    out = F
    for name, rate in rates.items():
        out = out.when(_c(tier) == name, rate)
    return out.otherwise(default)


def metrics(c) -> list[Column]:
    """total, average, min, max and count; zeros on empty input."""
    c = _c(c).cast("double")
    zero = F.lit(0.0)
    return [
        F.coalesce(F.sum(c), zero).alias("total"),
        F.coalesce(F.avg(c), zero).alias("average"),
        F.coalesce(F.min(c), zero).alias("min"),
        F.coalesce(F.max(c), zero).alias("max"),
        F.count(c).alias("count"),
    ]


def skewness(c) -> Column:
    """Bias-corrected sample skewness; null under three values."""
    n = F.count(_c(c)).cast("double")
    return F.when(n > 2, F.skewness(_c(c)) * F.sqrt(n * (n - 1)) / (n - 2))


def fixed(c, decimals: int = 2) -> Column:
    """Fixed decimals without separators, rounded on the exact binary value."""
    return F.translate(F.format_number(_c(c).cast("double"), decimals), ",", "")


def format_number(c, decimals: int = 0) -> Column:
    return F.format_number(_c(c).cast("double"), decimals)


def format_currency(c, currency: str = "₹", decimals: int = 2) -> Column:
    return F.concat(F.lit(currency), format_number(c, decimals))


def format_percentage(c, decimals: int = 1) -> Column:
    """Values from 0 to 1 are read as shares."""
    c = _c(c).cast("double")
    shown = F.when(c.between(0, 1), c * 100).otherwise(c)
    return F.concat(fixed(shown, decimals), F.lit("%"))


def format_file_size(c) -> Column:
    size = _c(c).cast("double")
    units = ("B", "KB", "MB", "GB", "TB")
    show = lambda power, unit: F.concat(fixed(size / F.lit(1024.0 ** power)), F.lit(f" {unit}"))
    out = F
    for power, unit in enumerate(units):
        out = out.when(size < 1024.0 ** (power + 1), show(power, unit))
    return out.otherwise(show(len(units), "PB"))
