"""Structured Streaming forms: running totals, validation, refresh, windowed counts.

Every sink is keyed by the batch id and overwrites, so a batch that is repeated
after a failure leaves the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.plans.marts import daily_state, merged_state, totals_of, with_trends


def arriving_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_batch: int = 100,
    name_filter: str | None = None, **options: str,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch).options(**options)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has arrived, batch by batch, and stop."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def running_totals(stream: DataFrame, out: str, checkpoint: str, *aggs: Column) -> StreamingQuery:
    """Aggregates over everything seen so far, one result per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return run_available(stream.agg(*aggs), write, checkpoint, "complete")


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.parquet(out)
    last = rows.agg(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == last).drop("batch_id")


def quarantine(stream: DataFrame, check: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Validate each batch with the batch rules; one write, split by `is_valid`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = check(batch).withColumn("is_valid", F.size("errors") == 0)
        checked.write.mode("overwrite").partitionBy("is_valid").parquet(f"{out}/batch_id={batch_id}")

    return run_available(stream, write, checkpoint)


def refresh_daily(orders: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep daily totals current as orders arrive.

    A batch leaves only its own state: counts, revenue and customer bitmaps by
    day, which add up exactly with those of all others. No earlier order or
    total is read again, whatever days the batch touches; `fold_daily` keeps
    the states few.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        daily_state(batch).write.mode("overwrite").parquet(f"{out}/state/batch_id={batch_id}")

    return run_available(orders, write, checkpoint)


def _has(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _folded(spark: SparkSession, out: str) -> int | None:
    """The last batch of the newest complete fold."""
    if not _has(spark, f"{out}/folds"):
        return None
    return spark.read.parquet(f"{out}/folds").agg(F.max("upto")).first()[0]


def stored_daily(spark: SparkSession, out: str) -> DataFrame:
    """The state of all batches: the newest fold and the batches after it."""
    upto = _folded(spark, out)
    later = spark.read.parquet(f"{out}/state")
    if upto is None:
        return merged_state(later.drop("batch_id"))
    later = later.filter(F.col("batch_id") > upto).drop("batch_id")
    return merged_state(spark.read.parquet(f"{out}/folded/upto={upto}").unionByName(later))


def fold_daily(spark: SparkSession, out: str) -> int:
    """Add the states of all finished batches up to one; the last batch's number.

    The fold counts once its mark is written; a fold that failed is not read
    and is written anew. Not to be run while batches are being written.
    """
    upto = spark.read.parquet(f"{out}/state").agg(F.max("batch_id")).first()[0]
    if upto != _folded(spark, out):
        stored_daily(spark, out).write.mode("overwrite").parquet(f"{out}/folded/upto={upto}")
        spark.createDataFrame([(upto,)], "upto long").coalesce(1).write.mode("append").parquet(f"{out}/folds")
    return upto


def refreshed_daily(spark: SparkSession, out: str) -> DataFrame:
    """The totals with moving averages and running total, computed on read."""
    return with_trends(totals_of(stored_daily(spark, out)))


def windowed_counts(
    stream: DataFrame, time: str, key: str, kind: str, amount: str, window: str = "1 hour", late: str = "10 minutes",
) -> DataFrame:
    """Events and amount by type in tumbling windows; repeats of a key are dropped
    while the watermark still remembers it, later rows are ignored."""
    unique = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return unique.groupBy(F.window(time, window), kind).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col(amount).cast("double")).alias("amount")
    ).select(F.col("window.start").alias("window_start"), kind, "events", "amount")


def append_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
