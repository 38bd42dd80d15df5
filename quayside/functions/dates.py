"""Date parts, calendar features, parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quayside.functions.numbers import fixed

# Season of each month, and the date formats tried in order.
SEASONS = {"Winter": (12, 1, 2), "Summer": (3, 4, 5), "Monsoon": (6, 7, 8, 9), "Autumn": (10, 11)}
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "yyyy.M.d", "MMM d, yyyy")
# Tried after DATE_FORMATS; stands in for an open-ended flexible parser.
MORE_FORMATS = ("yyyy/M/d", "d-M-yyyy", "d MMM yyyy", "MMMM d, yyyy", "yyyyMMdd", "yyyy-M-d HH:mm:ss")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    return F.trunc(_c(c), "month")


def day_of_week(c) -> Column:
    """0 = Sunday."""
    return (F.dayofweek(_c(c)) - 1).cast("bigint")


def date_parts(c, prefix: str = "") -> dict[str, Column]:
    c = _c(c)
    return {
        f"{prefix}year": F.year(c).cast("bigint"),
        f"{prefix}quarter": F.quarter(c).cast("bigint"),
        f"{prefix}month": F.month(c).cast("bigint"),
        f"{prefix}day_of_week": day_of_week(c),
    }


def season(c) -> Column:
    m = F.month(_c(c))
    out = F
    for name, months in SEASONS.items():
        out = out.when(m.isin(*months), name)
    return out


def calendar_features(c, prefix: str = "purchase_") -> dict[str, Column]:
    """Year to ISO week, weekday with 0 = Monday, and weekend / month-edge flags."""
    c = _c(c)
    weekday = F.weekday(c)
    return {
        f"{prefix}year": F.year(c).cast("bigint"),
        f"{prefix}month": F.month(c).cast("bigint"),
        f"{prefix}day": F.dayofmonth(c).cast("bigint"),
        f"{prefix}weekday": weekday.cast("bigint"),
        f"{prefix}quarter": F.quarter(c).cast("bigint"),
        f"{prefix}week_of_year": F.weekofyear(c).cast("bigint"),
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "is_month_start": (F.dayofmonth(c) == 1).cast("int"),
        "is_month_end": (c.cast("date") == F.last_day(c)).cast("int"),
        "season": season(c),
    }


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def age_months(later, earlier) -> Column:
    """Whole months from `earlier` to `later`, for later >= earlier."""
    a, b = _c(later), _c(earlier)
    months = (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
    return (months - (F.dayofmonth(a) < F.dayofmonth(b)).cast("int")).cast("bigint")


def age_years(later, earlier) -> Column:
    return F.floor(age_months(later, earlier) / 12).cast("bigint")


def age_month_part(later, earlier) -> Column:
    """The month field of an age: 0 to 11, the years left out."""
    return (age_months(later, earlier) % 12).cast("bigint")


def months_since(later, earlier, month_part_only: bool = False) -> Column:
    """Months between two month starts; optionally only the part below a year."""
    return age_month_part(later, earlier) if month_part_only else age_months(later, earlier)


def days_since(c, as_of) -> Column:
    return F.datediff(_c(as_of), _c(c)).cast("bigint")


def parse_date(c, formats=DATE_FORMATS + MORE_FORMATS) -> Column:
    """The first format that fits, else null."""
    text = F.trim(_c(c))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def is_valid_date(c, fmt: str = "yyyy-M-d") -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt)).isNotNull()


def format_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(c), fmt)


def format_duration(seconds) -> Column:
    s = _c(seconds).cast("double")
    show = lambda x, unit: F.concat(fixed(x), F.lit(f" {unit}"))
    return F.when(s < 60, show(s, "seconds")).when(s < 3600, show(s / 60, "minutes")).otherwise(
        show(s / 3600, "hours")
    )
