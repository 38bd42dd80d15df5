"""Series operations against pandas and hand-worked values."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from quayside.operators import series as S
from quayside.plans.features import purchase_stats

SALES = [100.0, 120.0, None, 150.0, None, 180.0, 200.0, None, 240.0, 260.0]


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(dt.date(2025, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(SALES)]
    return spark.createDataFrame(rows, "date date, sales double").repartition(3).cache()


def col(df, name, by="date"):
    return [r[name] for r in df.orderBy(by).collect()]


def test_fills(gaps):
    out = S.ffill_bfill(gaps, "date", ["sales"])
    s = pd.Series(SALES, dtype=float)
    assert col(out, "sales_ffill") == s.ffill().tolist()
    assert col(out, "sales_bfill") == s.bfill().tolist()


@pytest.mark.parametrize("min_rows", [1000, 2])
def test_linear(spark, min_rows):
    values = [None, 1.0, None, None, 4.0, 10.0, None, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    out = col(S.interpolate_linear(df, "i", "v", "x", min_rows=min_rows), "x", "i")
    want = pd.Series(values, dtype=float).interpolate().tolist()
    assert out[0] is None and out[1:] == pytest.approx(want[1:])


@pytest.mark.parametrize("min_rows", [1000, 3])
def test_quadratic_is_exact_on_a_parabola(spark, min_rows):
    rows = [(i, None if i in (0, 3, 4, 9, 13, 19) else 2.0 * i * i - 3 * i + 1) for i in range(20)]
    df = spark.createDataFrame(rows, "i int, v double")
    out = col(S.interpolate_quadratic(df, "i", "v", "x", min_rows=min_rows), "x", "i")
    for i, v in enumerate(out):
        if i in (0, 19):
            assert v is None
        else:
            assert v == pytest.approx(2.0 * i * i - 3 * i + 1)


def test_quadratic_uses_the_nearest_third_point(gaps):
    out = col(S.interpolate_quadratic(gaps, "date", "sales", "x"), "x")
    # Positions 2, 4, 6 hold 120, 150, 180: on a line, so the gap at 5 is 165.
    points = np.polyfit([1, 2, 4], [100, 120, 150], 2)
    assert out[2] == pytest.approx(np.polyval(points, 3))
    assert all(v is not None for v in out)


def test_quadratic_needs_three_points(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "i int, v double")
    assert col(S.interpolate_quadratic(df, "i", "v", "x"), "x", "i") == [1.0, None, 3.0]


def test_moving_averages(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(10)], "i int, v double")
    s = pd.Series([float(i * i) for i in range(10)])
    assert col(S.moving_average(df, "i", "v", 3, "m"), "m", "i") == pytest.approx(s.rolling(3, min_periods=1).mean().tolist())
    full = col(S.moving_average(df, "i", "v", 3, "m", full_only=True), "m", "i")
    assert full == pytest.approx(s.rolling(3).mean().dropna().tolist())
    assert S.moving_average(df, "i", "v", 11, "m", full_only=True).count() == 0


def test_lag_features(spark):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [("a", 1, t(1), 10.0), ("a", 2, t(3, 12), 20.0), ("a", 3, t(4, 11), 60.0), ("b", 4, t(2), 5.0)]
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp, v double")
    out = {r["id"]: r for r in S.lag_features(df, ["k"], "ts", ["ts", "id"], "v").collect()}
    assert [out[3][c] for c in ("prev_value", "prev_2_value", "rolling_avg_3", "days_since_last")] == [20.0, 10.0, 30.0, 0]
    assert out[2]["days_since_last"] == 2 and out[4]["prev_value"] is None and out[4]["rolling_avg_3"] == 5.0


def test_purchase_stats(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    got = {r["k"]: r for r in purchase_stats(df, "k", "v").collect()}
    assert got["a"]["purchase_std"] == pytest.approx(np.std([1, 3], ddof=1)) and got["b"]["purchase_std"] is None
    assert got["a"]["purchase_range"] == 2.0 and got["a"]["purchase_count"] == 2
