"""Exact quantiles against sorted lists."""

import random

import pytest

from galley.operators.quantiles import exact_quantiles

PERCENTS = (0, 1, 25, 50, 75, 90, 100)


def made_up(kind):
    chance = random.Random(11)
    if kind == "spread":
        return [chance.lognormvariate(0, 8) for _ in range(3000)]
    if kind == "ties":
        return [float(chance.choice([1, 1, 1, 1, 2, 7])) for _ in range(3000)]
    if kind == "mostly the largest":
        return [5.0] * 2950 + [chance.random() for _ in range(50)]
    if kind == "extremes":
        return [-1e300, 1e300, -0.5, 5e-324, 0.0] * 3 + [chance.gauss(0, 1) for _ in range(2000)]
    return {"one": [3.0], "two": [4.0, 3.0], "none": []}[kind]


@pytest.mark.parametrize("kind", ["spread", "ties", "mostly the largest", "extremes", "one", "two", "none"])
@pytest.mark.parametrize("small", [7, 100_000])
def test_values_at_ranks(spark, kind, small):
    values = made_up(kind)
    df = spark.createDataFrame([(v, 1) for v in [*values, None]], "v double, other int").repartition(4)
    found = {r["percentile"]: r["q"] for r in exact_quantiles(df, "v", PERCENTS, "q", small).collect()}
    ranked, n = sorted(values), len(values)
    assert found == {p: ranked[-(-n * p // 100) - 1] for p in PERCENTS if n and p}
