"""Record validation: rules as Columns, one projection, two filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayside.functions.numbers import fixed
from quayside.functions.rules import REGIONS


@dataclass
class RuleSet:
    """`required` columns are checked first; the rest only runs on complete records.

    `errors` and `warnings` are (bad, message) pairs.
    """

    errors: list[tuple[Column, Column | str]]
    warnings: list[tuple[Column, Column | str]] = field(default_factory=list)
    required: Sequence[str] = ()


def _messages(pairs) -> Column:
    items = [
        F.when(F.coalesce(bad, F.lit(False)), F.lit(text) if isinstance(text, str) else text)
        for bad, text in pairs
    ]
    if not items:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*items))


def check(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds `errors` and `warnings`, arrays of messages."""
    types = {f.name: f.dataType for f in df.schema}

    def blank(c: str) -> Column:
        empty = F.col(c).isNull()
        return empty | (F.col(c) == "") if isinstance(types[c], T.StringType) else empty

    lost = _messages([(blank(c), f"Missing required field: {c}") for c in rules.required])
    complete = F.size(lost) == 0
    return df.withColumns({
        "errors": F.when(complete, _messages(rules.errors)).otherwise(lost),
        "warnings": F.when(complete, _messages(rules.warnings)).otherwise(F.array().cast("array<string>")),
    })


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0)


def invalid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def totals(checked: DataFrame) -> DataFrame:
    """total, valid and invalid records, and warnings on the valid ones."""
    ok = F.size("errors") == 0
    return checked.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(F.when(ok, F.lit(1))).alias("valid_records"),
        F.count(F.when(~ok, F.lit(1))).alias("invalid_records"),
        F.coalesce(F.sum(F.when(ok, F.size("warnings").cast("bigint"))), F.lit(0)).alias("warnings"),
    )


def message_counts(checked: DataFrame) -> DataFrame:
    """Occurrences of each error, and of each warning on valid records."""
    tagged = F.concat(
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("kind"), m.alias("message"))),
        F.when(
            F.size("errors") == 0,
            F.transform("warnings", lambda m: F.struct(F.lit("warning").alias("kind"), m.alias("message"))),
        ).otherwise(F.array().cast("array<struct<kind:string,message:string>>")),
    )
    return checked.select(F.inline(tagged)).groupBy("kind", "message").agg(F.count(F.lit(1)).alias("n"))


def _shown(df: DataFrame, c: str) -> Column:
    """Plain number text: whole for integers, two decimals otherwise."""
    whole = isinstance(df.schema[c].dataType, T.IntegralType)
    return F.col(c).cast("string") if whole else fixed(c)


def _grouped(df: DataFrame, columns: Sequence[str], value: Column) -> Column:
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    return F.format_number(value.cast("bigint") if whole else value.cast("double"), 0 if whole else 2)


# Default limits for sales records.
SALES_LIMITS = {
    "price_min": 0,
    "price_max": 1_000_000,
    "quantity_min": 1,
    "quantity_max": 10_000,
    "valid_regions": REGIONS,
    "required_fields": ("product", "price", "quantity", "customer_id", "region"),
    "high_value_threshold": 500_000,
    "id_prefix": "C",
    "id_length": 4,
}


def sales_rules(df: DataFrame, **limits) -> RuleSet:
    """Rules for product, price, quantity, customer_id, region records."""
    cfg = SALES_LIMITS | limits
    price, qty, region = F.col("price"), F.col("quantity"), F.col("region")
    cid = F.trim(F.col("customer_id").cast("string"))
    revenue = price * qty
    return RuleSet(
        required=cfg["required_fields"],
        errors=[
            (price < cfg["price_min"], F.concat(F.lit("Price below minimum: ₹"), _shown(df, "price"))),
            (price > cfg["price_max"], F.concat(F.lit("Price above maximum: ₹"), _grouped(df, ["price"], price))),
            (qty < cfg["quantity_min"], F.concat(F.lit("Quantity below minimum: "), _shown(df, "quantity"))),
            (~region.isin(*cfg["valid_regions"]), F.concat(F.lit("Invalid region: "), region)),
            (F.length(F.trim("product")) < 2, "Product name too short"),
            (~cid.startswith(cfg["id_prefix"]) | (F.length(cid) < cfg["id_length"]),
             F.concat(F.lit("Invalid customer ID format: "), cid)),
        ],
        warnings=[
            (qty > cfg["quantity_max"], F.concat(F.lit("Unusually high quantity: "), _shown(df, "quantity"))),
            (revenue > cfg["high_value_threshold"],
             F.concat(F.lit("High-value order: ₹"), _grouped(df, ["price", "quantity"], revenue),
                      F.lit(" - Requires approval"))),
        ],
    )


def basic_rules(df: DataFrame, regions: Sequence[str] = REGIONS, high_value: float = 1_000_000) -> RuleSet:
    """The simple rule set: no early stop, a high revenue counts as an error."""
    price, qty = F.col("price"), F.col("quantity")
    cid, product = F.col("customer_id"), F.col("product")
    return RuleSet(errors=[
        (price <= 0, F.concat(F.lit("Invalid price: "), _shown(df, "price"))),
        (qty <= 0, F.concat(F.lit("Invalid quantity: "), _shown(df, "quantity"))),
        (cid.isNull() | (F.trim(cid) == ""), "Missing customer_id"),
        (product.isNull() | (F.length(product) < 2), "Invalid product name"),
        (F.col("region").isNull() | ~F.col("region").isin(*regions),
         F.concat(F.lit("Invalid region: "), F.coalesce("region", F.lit("None")))),
        (price * qty > high_value,
         F.concat(F.lit("High value order: ₹"), _grouped(df, ["price", "quantity"], price * qty),
                  F.lit(" - Needs approval"))),
    ])


def file_check_rules() -> RuleSet:
    return RuleSet(errors=[
        (F.col("price") <= 0, "Invalid price"),
        (F.col("quantity") <= 0, "Invalid quantity"),
        (F.col("customer_id").isNull(), "Missing customer_id"),
    ])


def file_check(df: DataFrame) -> DataFrame:
    """Counts and shares of valid and invalid rows, and the valid rows' revenue."""
    checked = check(df, file_check_rules())
    ok = F.size("errors") == 0
    n = F.count(F.lit(1))
    good, bad = F.count(F.when(ok, F.lit(1))), F.count(F.when(~ok, F.lit(1)))
    rev = (F.col("price").cast("decimal(12,2)") * F.col("quantity").cast("decimal(6,0)"))
    return checked.agg(
        n.alias("total_records"),
        good.alias("valid_records"),
        F.try_divide(good * 100.0, n).alias("valid_pct"),
        bad.alias("invalid_records"),
        F.try_divide(bad * 100.0, n).alias("invalid_pct"),
        F.coalesce(F.sum(F.when(ok, rev)).cast("double"), F.lit(0.0)).alias("total_revenue"),
    )


def error_class(df: DataFrame, price: str, quantity: str, customer_id: str) -> Column:
    """Why a raw text record cannot be processed: the first failing step."""
    return (
        F.when(F.col(price).isNull(), "Missing field: price")
        .when(F.col(quantity).isNull(), "Missing field: quantity")
        .when(F.col(price).try_cast("double").isNull(), "Type error: price")
        .when(F.col(quantity).try_cast("double").isNull(), "Type error: quantity")
        .when(F.col(customer_id).isNull(), "Missing field: customer_id")
        .when(F.col(customer_id).try_cast("double").isNotNull(), "Attribute error: customer_id")
        .otherwise("OK")
    )


def status(count: Column, warn_below: int = 10) -> Column:
    return F.when(count == 0, "PASS").when(count < warn_below, "WARNING").otherwise("FAIL")


def issue(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("issue_count")).select(F.lit(name).alias("issue_type"), "issue_count")


def issue_report(issues: dict[str, DataFrame]) -> DataFrame:
    """One row per check: offending rows and PASS / WARNING / FAIL."""
    parts = [issue(name, rows) for name, rows in issues.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("status", status(F.col("issue_count")))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def key_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unmatched(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows without a partner. The other side is reduced to its distinct keys
    first: they combine before the shuffle, so a hot key there weighs nothing."""
    keys = other.select(F.col(other_column).alias("_other")).distinct()
    return df.join(keys, F.col(column) == F.col("_other"), "left_anti")


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return unmatched(child.filter(F.col(column).isNotNull()), column, parent, parent_column)
