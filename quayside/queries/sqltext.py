"""Fragments shared by the oracle SQL, mirroring `functions.exact`."""

LINE_TOTAL = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))))"
AS_OF = "DATE '2001-08-01'"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def total(x: str) -> str:
    return f"CAST(SUM({money(x)}) AS DOUBLE)"


def mean(x: str) -> str:
    return f"(CAST(SUM({money(x)}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def half_up(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def age_months(later: str, earlier: str) -> str:
    """Whole months, by the calendar-field formula."""
    return (
        f"((EXTRACT(YEAR FROM {later}) - EXTRACT(YEAR FROM {earlier})) * 12"
        f" + EXTRACT(MONTH FROM {later}) - EXTRACT(MONTH FROM {earlier})"
        f" - CASE WHEN EXTRACT(DAY FROM {later}) < EXTRACT(DAY FROM {earlier}) THEN 1 ELSE 0 END)"
    )
