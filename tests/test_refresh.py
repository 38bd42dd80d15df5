"""Refresh by key: only changed partitions are written, readers keep their version."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.sources import refresh as R

SCHEMA = "k string, part string, v double, tags map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted([(r.k, r.part, r.v) for r in df.collect()], key=repr)


def files(spark, name):
    """File -> time of change, by version and partition."""
    found = {}
    for f in spark.table(f"{name}__data").inputFiles():
        path = f.removeprefix("file://").removeprefix("file:")
        from urllib.parse import unquote
        path = unquote(path)
        found[path] = os.stat(path).st_mtime_ns
    return found


FIRST = [("a", "x", 1.0, {"t": 1}), ("b", "x", 2.0, None), ("c", "y", 3.0, None), ("d", None, 4.0, None), ("e", "o'n/e", 5.0, None), (None, "z", 6.0, None)]


@pytest.fixture
def name(spark):
    name = "refreshed_result"
    R.drop_refreshed(spark, name)
    yield name
    R.drop_refreshed(spark, name)


def test_only_changed_partitions_are_written(spark, name):
    assert R.refresh(frame(spark, FIRST), name, ["k"], ["part"]) == 1
    assert rows_of(spark.table(name)) == rows_of(frame(spark, FIRST))
    before = files(spark, name)
    reader = spark.table(name)
    # b changes, c moves from y to a new partition and leaves y empty, f comes
    second = [FIRST[0], ("b", "x", 2.5, None), ("c", "w", 3.0, None), *FIRST[3:], ("f", "z", 7.0, None)]
    assert R.refresh(frame(spark, second), name, ["k"], ["part"]) == 2
    assert rows_of(spark.table(name)) == rows_of(frame(spark, second))
    held = {r.part: r._version for r in R.manifest(spark, name).collect()}
    assert held == {"x": 2, "w": 2, "z": 2, None: 1, "o'n/e": 1}
    assert rows_of(reader) == rows_of(frame(spark, FIRST))
    after = files(spark, name)
    assert before.items() <= after.items() and all("_version=2" in f for f in after.keys() - before.keys())

    assert R.refresh(frame(spark, second), name, ["k"], ["part"]) == 3  # nothing changed, nothing is written
    assert rows_of(spark.table(name)) == rows_of(frame(spark, second))
    assert not [f for f in files(spark, name) if "_version=3" in f]
    # version 1 is past: of its files only those still named are left
    assert {f for f in files(spark, name) if "_version=1" in f} == {
        f for f in before if "part=__HIVE_DEFAULT" in f or "n%2Fe" in f or "o'n" in f}
    assert R.refreshed_versions(spark, name) == [2, 3]


def test_map_values_and_repeated_keys(spark, name):
    R.refresh(frame(spark, FIRST), name, ["k"], ["part"])
    with pytest.raises(ValueError, match="not unique"):
        R.refresh(frame(spark, [FIRST[0], FIRST[0]]), name, ["k"], ["part"])
    with pytest.raises(ValueError, match="not unique"):
        R.refresh(frame(spark, [FIRST[5], FIRST[5]]), name, ["k"], ["part"])
    assert R.refreshed_versions(spark, name) == [1] and spark.table(name).count() == 6
    R.refresh(frame(spark, []), name, ["k"], ["part"])
    assert spark.table(name).count() == 0 and R.manifest(spark, name).count() == 0


def test_rest_of_a_failed_run_is_replaced(spark, name):
    R.refresh(frame(spark, FIRST), name, ["k"], ["part"])
    left = frame(spark, [("q", "x", 9.0, None)]).withColumn("_version", F.lit(2))
    left.select(*spark.table(f"{name}__data").columns).write.mode("append").format("parquet").partitionBy("_version", "part").saveAsTable(f"{name}__data")
    second = [("a", "x", 1.5, None), *FIRST[1:]]
    R.refresh(frame(spark, second), name, ["k"], ["part"])
    assert rows_of(spark.table(name)) == rows_of(frame(spark, second))
