"""Writing checked records: valid and invalid apart, with a text report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayside.operators.quality import totals
from quayside.sources.files import write_frame


def report_lines(checked: DataFrame, record_no: str) -> DataFrame:
    """The report as (section, record, line): counts, then one line per error."""
    t = totals(checked)
    head = t.select(F.explode(F.array(
        F.struct(F.lit(1).alias("at"), F.concat(F.lit("Total Records: "), "total_records").alias("line")),
        F.struct(F.lit(2).alias("at"), F.concat(F.lit("Valid Records: "), "valid_records").alias("line")),
        F.struct(F.lit(3).alias("at"), F.concat(F.lit("Invalid Records: "), "invalid_records").alias("line")),
        F.struct(F.lit(4).alias("at"), F.concat(F.lit("Warnings: "), "warnings").alias("line")),
    )).alias("r")).select(F.lit(0).alias("section"), F.col("r.at").cast("bigint").alias("record"), F.col("r.line").alias("line"))
    body = checked.select(F.col(record_no).cast("bigint").alias("record"), F.explode("errors").alias("error")).select(
        F.lit(1).alias("section"), "record",
        F.concat(F.lit("Record #"), F.col("record").cast("string"), F.lit(": "), "error").alias("line"),
    )
    return head.unionByName(body)


def write_quarantine(checked: DataFrame, path: str, run_id: str, record_no: str) -> None:
    """One write of all records, split by `is_valid`, and the ordered report as text."""
    base = f"{path}/run_id={run_id}"
    rows = checked.withColumn("is_valid", F.size("errors") == 0)
    rows.write.partitionBy("is_valid").parquet(f"{base}/records")
    saved = checked.sparkSession.read.schema(rows.schema).parquet(f"{base}/records")
    lines = report_lines(saved, record_no).orderBy("section", "record", "line").select("line")
    lines.write.text(f"{base}/report")


def write_sides(checked: DataFrame, path: str, fmt: str = "csv") -> None:
    """Valid and invalid records as two outputs; the error list is joined as text."""
    texts = {c: F.array_join(c, "; ") for c in ("errors", "warnings")}
    good = checked.filter(F.size("errors") == 0).drop("errors", "warnings")
    bad = checked.filter(F.size("errors") > 0).withColumns(texts)
    write_frame(good, f"{path}/valid", fmt)
    write_frame(bad, f"{path}/invalid", fmt)
