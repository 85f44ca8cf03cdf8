"""Exact quantiles against sorted values."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from incidentlake.operators import quantiles
from incidentlake.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def at(values, p):
    values = sorted((v for v in values if v is not None), key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    n = len(values)
    return values[max(1, n - math.floor(n - p * n)) - 1] if n else None


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def columns(n):
    draw = random.Random(5)
    moment = dt.datetime(1970, 1, 1)
    return {
        "tied double": [draw.choice([0.0, -0.0, 1.5, -2.25]) for _ in range(n)],
        "wide double": [draw.choice([1, -1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(n)],
        "close double": [1 + draw.randrange(2 ** 20) * 2.0 ** -52 for _ in range(n)],
        "odd double": [draw.choice([math.inf, -math.inf, math.nan, 5e-324, -5e-324, 0.0, 1.7e308, None]) for _ in range(n)],
        "wide bigint": [draw.randrange(-2 ** 63, 2 ** 63) for _ in range(n)],
        "close bigint": [2 ** 62 + draw.randrange(50) for _ in range(n)],
        "hot int": [7 if i % 3 else draw.randrange(-9, 9) for i in range(n)],
        "day date": [dt.date(1960, 1, 1) + dt.timedelta(draw.randrange(20_000)) for _ in range(n)],
        "zone-free timestamp_ntz": [moment + dt.timedelta(microseconds=draw.randrange(-10 ** 15, 10 ** 15)) for _ in range(n)],
        "money decimal(12,2)": [Decimal(draw.randrange(-10 ** 9, 10 ** 9)).scaleb(-2) for _ in range(n)],
        "none double": [None] * n,
    }


def frame_of(spark, data):
    schema = ", ".join(f"`{name}` {name.split()[-1]}" for name in data)
    return spark.createDataFrame(list(zip(*data.values())), schema).repartition(5)


def test_values_at_ranks_in_four_scans(spark, monkeypatch):
    scans = []
    count = quantiles._count
    monkeypatch.setattr(quantiles, "_count", lambda *a: scans.append(a) or count(*a))
    data = columns(3000)
    rows = exact_quantiles(frame_of(spark, data), list(data), PROBABILITIES).collect()
    assert [r["probability"] for r in rows] == PROBABILITIES
    for row in rows:
        for name, values in data.items():
            assert same(row[name], at(values, row["probability"])), (name, row["probability"])
    assert len(scans) <= 4


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_few_rows(spark, n):
    data = {"a double": [float(i % 4) for i in range(n)], "b bigint": [i * i for i in range(n)]}
    for row in exact_quantiles(frame_of(spark, data), list(data), PROBABILITIES).collect():
        for name, values in data.items():
            assert row[name] == at(values, row["probability"])


def test_empty_repeated_and_refused(frame):
    empty = exact_quantiles(frame([], "x double, t string"), ["x"], [0.5, 0.5]).collect()
    assert [tuple(r) for r in empty] == [(0.5, None)] * 2
    with pytest.raises(ValueError, match="type string"):
        exact_quantiles(frame([], "x double, t string"), ["t"], [0.5])
    with pytest.raises(ValueError, match="between 0 and 1"):
        exact_quantiles(frame([], "x double"), ["x"], [25])
