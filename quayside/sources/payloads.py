"""Flattening nested API payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PRICE_MAP = "map<string,struct<usd:double,usd_24h_change:double,inr:double,inr_24h_change:double>>"


def entity_rows(df: DataFrame, payload: Column | str, taken_at: Column, map_type: str = PRICE_MAP) -> DataFrame:
    """A JSON map keyed by entity -> one row per entity with its fields and the time."""
    text = F.col(payload) if isinstance(payload, str) else payload
    keep = [c for c in df.columns if c != payload]
    rows = df.select(*keep, F.explode(F.from_json(text, map_type)).alias("entity", "_v"), taken_at.alias("taken_at"))
    return rows.select(*keep, "entity", "_v.*", "taken_at")


def person_rows(df: DataFrame, people: str) -> DataFrame:
    """An array of nested user records -> flat rows."""
    p = df.select(F.explode(people).alias("p"))
    return p.select(
        F.concat_ws(" ", "p.name.first", "p.name.last").alias("name"), F.col("p.email").alias("email"),
        F.col("p.location.city").alias("city"), F.col("p.location.state").alias("state"),
        F.col("p.location.country").alias("country"),
    )


def nested_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """new name -> dotted path below a struct column."""
    return df.select(*[F.col(f"{column}.{path}").alias(name) for name, path in fields.items()])
