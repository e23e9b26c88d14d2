"""Exact medians against a sort in memory."""

import math
import random
import statistics

import pytest

from stationflow.operators.medians import (
    column_medians,
    exact_median_fill,
    exact_medians,
    median_impute,
    value_counts,
)

COLUMNS = ["few", "many", "odd", "sparse", "none", "spread"]


@pytest.fixture(scope="module")
def table(spark):
    random.seed(3)
    data = [
        (
            float(random.randint(0, 3)),
            random.gauss(0, 1),
            float(i) if i < 2001 else None,
            random.random() if i % 400 == 0 else None,
            None,
            random.choice([-1e300, 1e300, 5.0]),
        )
        for i in range(3000)
    ]
    return data, spark.createDataFrame(data, ", ".join(f"{c} double" for c in COLUMNS)).repartition(6)


def present(data, i):
    return sorted(r[i] for r in data if r[i] is not None)


# With a margin this narrow many brackets miss the median and are computed again.
@pytest.mark.parametrize("sample_rows, margin", [(None, 0.1), (500, 0.1), (300, 0.2), (50, 0.0001)])
@pytest.mark.parametrize("rows_per_block", [None, 20])
def test_medians_are_exact(table, sample_rows, margin, rows_per_block):
    data, frame = table
    low = column_medians(frame, COLUMNS, None, sample_rows, margin, rows_per_block).first()
    middle = exact_medians(frame, COLUMNS, sample_rows, margin, rows_per_block).first()
    for i, c in enumerate(COLUMNS):
        values = present(data, i)
        assert low[c] == (statistics.median_low(values) if values else None), c
        assert middle[c] == (pytest.approx(statistics.median(values), rel=1e-15) if values else None), c


def test_approximate_form_agrees_on_small_data(table):
    _, frame = table
    assert column_medians(frame, COLUMNS, accuracy=1_000_000).first() == column_medians(frame, COLUMNS).first()


def test_values_outside_a_bracket_are_counted_together(table):
    data, frame = table
    counted = value_counts(frame, ["many"], {"many": [-0.1, 0.1]}).collect()
    assert sum(r["n"] for r in counted) == 3000
    outside = {r["value"]: r["n"] for r in counted if math.isinf(r["value"])}
    values = present(data, 1)
    assert outside == {-math.inf: sum(v < -0.1 for v in values), math.inf: sum(v > 0.1 for v in values)}


def test_fill_uses_zero_for_a_column_without_values(spark):
    frame = spark.createDataFrame([(1.0, None), (3.0, None), (9.0, None), (None, None)], "a double, b double")
    assert sorted(map(tuple, median_impute(frame, ["a", "b", "absent"]).collect())) == [
        (1.0, 0.0), (3.0, 0.0), (3.0, 0.0), (9.0, 0.0),
    ]


def test_exact_fill_touches_only_incomplete_numeric_columns(spark):
    frame = spark.createDataFrame(
        [(1.0, 5, "x", None), (2.0, 6, None, None), (None, 7, "y", None)], "a double, n int, s string, e double"
    )
    filled = exact_median_fill(frame)
    assert filled.dtypes[1] == ("n", "int")
    assert sorted(map(str, filled.collect())) == sorted(
        ["Row(a=1.0, n=5, s='x', e=None)", "Row(a=2.0, n=6, s=None, e=None)", "Row(a=1.5, n=7, s='y', e=None)"]
    )


def test_nan_is_missing_for_the_interpolated_median_and_largest_otherwise(spark):
    frame = spark.createDataFrame([(float("nan"),), (1.0,), (float("nan"),), (2.0,)], "a double")
    assert exact_medians(frame, ["a"]).first()["a"] == 1.5
    assert column_medians(frame, ["a"]).first()["a"] == 2.0
