import random

import numpy as np
import pytest

from quayside.operators.quantiles import quantiles


@pytest.mark.parametrize("few,accuracy", [(100_000, 10_000), (5, 20), (5, 300), (5, 10_000), (700, 1000)])
def test_matches_linear_interpolation(spark, few, accuracy):
    rng = random.Random(3)
    data = [
        (rng.gauss(0, 100), 7.0 if rng.random() < 0.5 else float(rng.randint(0, 30)),
         None if rng.random() < 0.9 else rng.random(), None)
        for _ in range(2011)
    ]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    out = quantiles(df, ["a", "b", "c", "d"], probs, few, accuracy)
    for i, name in enumerate("abc"):
        values = [r[i] for r in data if r[i] is not None]
        assert out[name] == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)
    assert out["d"] == [None] * len(probs)


def test_single_row_and_constant(spark):
    df = spark.createDataFrame([(3.0, 1)], "a double, b int")
    assert quantiles(df, ["a", "b"], [0.25, 0.5]) == {"a": [3.0, 3.0], "b": [1.0, 1.0]}
