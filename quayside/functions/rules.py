"""Field rules: Column -> struct<ok: boolean, error: string>.

Wording and limits are fixed values; the defaults serve retail records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from quayside.functions import dates, text

# Fixed values.
REGIONS = ("North", "South", "East", "West")
PHONE_PATTERN = r"^[6-9]\d{9}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _verdict(*checks: tuple[Column, Column | str]) -> Column:
    """The message of the first failing check."""
    error = F
    for bad, message in checks:
        message = F.lit(message) if isinstance(message, str) else message
        error = error.when(F.coalesce(bad, F.lit(False)), message)
    error = error.otherwise(F.lit(None).cast("string"))
    return F.struct(error.isNull().alias("ok"), error.alias("error"))


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def email(c) -> Column:
    return _verdict((~text.is_email(c), "Invalid email format"))


def phone(c) -> Column:
    bare = F.regexp_replace(_c(c), "[ -]", "")
    return _verdict((~F.coalesce(bare.rlike(PHONE_PATTERN), F.lit(False)), "Invalid phone number"))


def price(c, low: float = 0, high: float | None = None) -> Column:
    number = _c(c).try_cast("double")
    checks = [
        (number.isNull(), "Invalid price format"),
        (number < 0, "Price cannot be negative"),
        (number < low, f"Price below minimum: ₹{low}"),
    ]
    if high is not None:
        checks.append((number > high, f"Price above maximum: ₹{high}"))
    return _verdict(*checks)


def quantity(c, low: int = 1, high: int = 10000) -> Column:
    number = _c(c).try_cast("int")
    return _verdict(
        (number.isNull(), "Invalid quantity format"),
        (number < low, f"Quantity below minimum: {low}"),
        (number > high, f"Quantity above maximum: {high}"),
    )


def date(c, fmt: str = "yyyy-M-d", shown: str = "%Y-%m-%d") -> Column:
    return _verdict((~dates.is_valid_date(c, fmt), f"Invalid date format. Expected: {shown}"))


def customer_id(c, prefix: str = "C", min_length: int = 4) -> Column:
    c = _c(c)
    shaped = text.clean_id(c)
    rest = shaped.substr(F.lit(len(prefix) + 1), F.length(shaped))
    return _verdict(
        (_blank(c), "Customer ID is required"),
        (~shaped.startswith(prefix), f"Customer ID must start with '{prefix}'"),
        (F.length(shaped) < min_length, f"Customer ID too short (min: {min_length})"),
        (~rest.rlike(r"^\d+$"), "Customer ID must end with numbers"),
    )


def region(c, valid: Sequence[str] = REGIONS) -> Column:
    c = _c(c)
    return _verdict(
        (_blank(c), "Region is required"),
        (~c.isin(*valid), f"Invalid region. Must be one of: {', '.join(valid)}"),
    )
