"""The cleaning run: profile, fill, dedup, cap, text, narrow, report.

Each step learns a few figures from one or two aggregates and applies them as
literals. The table is written to the shared folder once, after dedup, because
the later steps read it several times and dedup is the only step that shuffles
whole rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from quayside.functions import text
from quayside.operators.columns import columns_like, numeric_columns, text_columns
from quayside.operators.dedup import keep_one
from quayside.operators.missing import fill, learn_fill
from quayside.operators.narrowing import narrow
from quayside.operators.outliers import cap_outliers, iqr_bounds, outside
from quayside.operators.profile import quality_profile
from quayside.session import materialise


@dataclass
class CleaningConfig:
    numeric_strategy: str = "median"
    text_strategy: str = "mode"
    dedup_subset: Sequence[str] | None = None
    keep: str = "first"
    outlier_width: float = 1.5
    lowercase_emails: bool = True
    title_case_names: bool = True
    standardize_phones: bool = True


@dataclass
class CleaningReport:
    """Ordered steps with their figures."""

    steps: list[tuple[str, dict]] = field(default_factory=list)

    def add(self, step: str, **figures) -> None:
        self.steps.append((step, figures))

    def frame(self, spark) -> DataFrame:
        rows = [(i + 1, s, json.dumps(d, sort_keys=True, default=str)) for i, (s, d) in enumerate(self.steps)]
        return spark.createDataFrame(rows, "step_no int, step string, details string")


def clean_text_columns(df: DataFrame, config: CleaningConfig) -> tuple[DataFrame, dict[str, list[str]]]:
    """E-mails lowered, names in title case, phones as digits, picked by column name."""
    texts = text_columns(df)
    found = {kind: [c for c in columns_like(df, kind) if c in texts] for kind in ("email", "name", "phone")}
    new = {}
    if config.lowercase_emails:
        new |= {c: text.clean_email(c) for c in found["email"]}
    if config.title_case_names:
        new |= {c: text.title_case(text.strip(c)) for c in found["name"]}
    if config.standardize_phones:
        new |= {c: text.digits(c) for c in found["phone"]}
    return df.withColumns(new), found


def clean(df: DataFrame, row_key: str, config: CleaningConfig | None = None) -> tuple[DataFrame, CleaningReport]:
    """Returns the cleaned table and the report. `row_key` is unique and gives the row order."""
    config, report = config or CleaningConfig(), CleaningReport()
    data = [c for c in df.columns if c != row_key]
    found = quality_profile(df.select(*data), per_column=True).first().asDict()
    nulls = {c: found[f"missing__{c}"] for c in data}
    start = {k: v for k, v in found.items() if not k.startswith("missing__")}
    report.add("analyze_quality", **start)

    strategies = {c: config.numeric_strategy for c in numeric_columns(df) if c != row_key}
    strategies |= {c: config.text_strategy for c in text_columns(df) if c != row_key}
    learnt = learn_fill(df, {c: s for c, s in strategies.items() if nulls[c]})
    table = fill(df, learnt)
    before, filled = start["missing_values"], sum(nulls[c] for c, v in learnt.items() if v is not None)
    report.add("handle_missing", before=before, after=before - filled, filled=filled)

    unique = materialise(keep_one(table, config.dedup_subset or data, row_key, config.keep), "cleaning")
    numbers = [c for c in numeric_columns(unique) if c != row_key]
    bounds = iqr_bounds(unique, numbers, config.outlier_width)
    row = unique.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(outside(c, b), F.lit(1))).alias(c) for c, b in bounds.items()],
    ).first()
    total = start["total_rows"]
    report.add("remove_duplicates", before=total, after=row["_rows"], removed=total - row["_rows"])

    hit = {c: row[c] for c in bounds if row[c]}
    capped = cap_outliers(unique, {c: bounds[c] for c in hit})
    report.add("handle_outliers", **hit)

    tidy, texts = clean_text_columns(capped, config)
    report.add("clean_text", **{f"{k}_cols": v for k, v in texts.items()})

    slim = narrow(tidy)
    changed = {c: t for c, t in slim.dtypes if dict(tidy.dtypes)[c] != t}
    report.add("optimize_types", narrowed=changed)

    final = quality_profile(slim.select(*data)).first().asDict()
    report.add("final", **final)
    return slim, report
