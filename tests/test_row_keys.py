"""Row keys, saved results of another database, streams over tables of many files."""

from pyspark.sql import functions as F

from quayside.operators.dedup import keep_one
from quayside.operators.profile import distinct_rows
from quayside.queries import QUERIES
from quayside.sources import catalog


def test_keys_hold_microseconds_and_zeros(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', timestamp'2024-01-01 00:00:00.000001', 0.0D), (2, 'a', timestamp'2024-01-01 00:00:00.000002', 0.0D),
        (3, 'a', timestamp'2024-01-01 00:00:00.000002', -0.0D), (4, NULL, NULL, NULL), (5, NULL, NULL, NULL) AS t(id, name, at, x)""")
    assert sorted(r.id for r in keep_one(df, ["name", "at", "x"], "id").collect()) == [1, 2, 4]
    assert tuple(distinct_rows(df, ["name", "at", "x"]).first()) == (5, 3)


def test_publish_in_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    assert [catalog.publish(spark.range(n), "shelf.counts") for n in (1, 2, 3)] == [1, 2, 3]
    assert spark.table("shelf.counts").count() == 3 and catalog.versions(spark, "shelf.counts") == [2, 3]


def test_streams_over_folders(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("lineitem", "orders", "events"):
        spark.read.parquet(f"{source}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("st_running_totals", "st_quarantine"):
        want, got = QUERIES[name](spark, source), QUERIES[name](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    counted = QUERIES["st_windowed_counts"](spark, str(tmp_path))
    assert counted.agg(F.sum("events")).first()[0] > 0
