"""Exact quantiles by counting passes equal ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from tickframe.operators.quantiles import exact_quantiles

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _columns():
    rng = random.Random(3)
    return {
        "spread": [rng.gauss(0, 1) * 10 ** rng.randint(-3, 3) for _ in range(120)],
        "ties": [float(rng.randint(0, 3)) for _ in range(120)],
        "hot": [7.5] * 90 + [rng.random() for _ in range(30)],
        "wide": [rng.choice((-1, 1)) * 10.0 ** rng.randint(-300, 307) for _ in range(120)],
        "near": [1.0 + k * 2.0 ** -52 for k in range(120)],
        "nulls": [None if k % 3 else float(k) for k in range(120)],
    }


@pytest.mark.parametrize("bins,few", [(16, 5), (1024, 4096)])
def test_equal_percentile(spark, bins, few):
    cols = _columns()
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).cache()
    for c in cols:
        want = list(df.agg(*[F.percentile(c, p) for p in PS]).first())
        assert exact_quantiles(df, c, PS, bins, few) == want, c


def test_no_values(spark):
    assert exact_quantiles(spark.createDataFrame([(None,), (float("nan"),)], "x double"), "x", [0.5]) == [None]
