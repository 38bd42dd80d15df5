"""Parent-child trees."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F, types as T

from quayside.functions.text import indent
from quayside.session import scratch_path


def tree(nodes: DataFrame, id_col: str, parent_col: str, name_col: str, separator: str = " > ") -> DataFrame:
    """id, indented name, full path and level, from the roots (null parent) down, however deep.

    By pointer doubling: a row knows the path to some ancestor and who is above
    it, and in each round takes over the path of that one, so a tree of depth d
    takes about log2(d) rounds. Each round is written to the shared folder
    before the next one reads it; rows that have reached a root are written
    once. A row carries its path and a pointer; the ids on the path come along
    only where ids occur more than once.

    A cycle without a root is not reached, nor is what hangs from a parent that
    is not there; where an id occurs again below itself, it is not followed
    further.
    """
    spark = nodes.sparkSession
    base = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), F.col(name_col).alias("name"))
    repeated = not base.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    seen = [F.array("id").alias("seen")] if repeated else []
    step = base.select("id", "name", "up", F.col("name").alias("path"), F.lit(0).cast("long").alias("level"), *seen)
    schema = T.StructType([*step.schema.fields, T.StructField("round", T.IntegerType()), T.StructField("done", T.BooleanType())])
    out = scratch_path(spark, "tree")
    for k in count():
        step.withColumn("done", F.col("up").isNull()).write.partitionBy("done").parquet(f"{out}/round={k}")
        saved = spark.read.schema(schema).parquet(out)
        rows = {r["done"]: r["n"] for r in saved.where(F.col("round") == k).groupBy("done").agg(F.count(F.lit(1)).alias("n")).collect()}
        # Depths have no holes: when a round reaches no root, those left never will.
        if not rows.get(True) or not rows.get(False):
            break
        above = saved.where(F.col("done") | (F.col("round") == k)).select(
            F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("level").alias("_level"),
            *([F.col("seen").alias("_seen")] if repeated else []))
        met = saved.where((F.col("round") == k) & ~F.col("done")).join(above, F.col("up") == F.col("_id"))
        if repeated:
            met = met.where(~F.coalesce(F.arrays_overlap("seen", "_seen"), F.lit(False)))
        step = met.select(
            "id", "name", F.col("_up").alias("up"), F.concat("_path", F.lit(separator), "path").alias("path"),
            (F.col("_level") + F.col("level") + 1).alias("level"), *([F.concat("_seen", "seen").alias("seen")] if repeated else []))
    found = spark.read.schema(schema).parquet(out).where("done")
    return found.select("id", indent("name", F.col("level")).alias("indented_name"), F.col("path").alias("full_path"), "level")
