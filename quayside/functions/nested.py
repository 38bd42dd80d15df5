"""JSON text, arrays, maps and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_records(c, element: str) -> Column:
    """JSON text -> array of structs; a single object becomes a one-element array."""
    text = F.trim(_c(c))
    many = F.from_json(text, f"array<{element}>")
    one = F.array(F.from_json(text, element))
    return F.when(text.startswith("["), many).otherwise(one)


def zip_to_map(keys, values) -> Column:
    return F.map_from_arrays(_c(keys), _c(values))


def with_entry(m, key: str, value) -> Column:
    """The map with `key` set, replacing an older entry."""
    rest = F.map_filter(_c(m), lambda k, _: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def lookup(c, mapping: dict) -> Column:
    """Dictionary lookup on a column; null for unknown keys."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def joined(c, sep: str = ",") -> Column:
    return F.array_join(_c(c), sep)


def unpack(c, names: Sequence[str]) -> dict[str, Column]:
    """The first elements of an array as columns."""
    return {n: F.get(_c(c), F.lit(i)) for i, n in enumerate(names)}
