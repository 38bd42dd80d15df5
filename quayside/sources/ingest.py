"""Several sources in one run: tag, write, and report each on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from quayside.sources.files import write_frame

STATUS = "source string, status string, records long, error string, path string"


def tag_source(df: DataFrame, name: str, ingested_at: Column | None = None) -> DataFrame:
    """Adds the source's name and the ingestion time."""
    return df.withColumns({
        "data_source": F.lit(name),
        "ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
    })


def ingest(
    spark: SparkSession, sources: dict[str, Callable[[SparkSession], DataFrame]], path: str, run_id: str,
    fmt: str = "parquet", ingested_at: Column | None = None,
) -> DataFrame:
    """Load and save each source under `path/run_id=<id>/<source>`; returns the status table.

    A source's failure, at load or at its write, marks that source alone. The
    record count is observed during the write, so nothing is scanned twice.
    """
    rows = []
    for name, load in sources.items():
        target = f"{path}/run_id={run_id}/{name}"
        try:
            seen = Observation()
            df = tag_source(load(spark), name, ingested_at).observe(seen, F.count(F.lit(1)).alias("n"))
            write_frame(df, target, fmt)
            rows.append((name, "success", seen.get["n"], None, target))
        except Exception as e:  # noqa: BLE001 - one source must not stop the others
            rows.append((name, "failed", 0, f"{type(e).__name__}: {e}", None))
    status = spark.createDataFrame(rows, STATUS)
    write_frame(status, f"{path}/run_id={run_id}/_results", "json")
    return status
