"""Regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _metrics(df: DataFrame, name: str, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One pass over ``df``, then one output row per pair of label and prediction columns."""
    sums = []
    for i, (label, prediction) in enumerate(pairs.values()):
        both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
        y = F.when(both, F.col(label).cast("double"))
        error = F.col(label).cast("double") - F.col(prediction).cast("double")
        sums += [
            F.sum(error * error).alias(f"res_{i}"),
            F.count(y).alias(f"n_{i}"),
            (F.var_pop(y) * F.count(y)).alias(f"tot_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(key).alias(name),
            F.col(f"n_{i}").alias("n"),
            F.when(F.col(f"n_{i}") > 0, F.sqrt(F.col(f"res_{i}") / F.col(f"n_{i}"))).alias("rmse"),
            F.when(F.col(f"tot_{i}") > 0, 1 - F.col(f"res_{i}") / F.col(f"tot_{i}"))
            .when(F.col(f"res_{i}") == 0, 1.0)
            .when(F.col(f"res_{i}") > 0, 0.0)
            .alias("r2"),
        )
        for i, key in enumerate(pairs)
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def regression_metrics(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """RMSE and R2 per target; ``pairs`` maps a name to (label column, prediction column)."""
    return _metrics(df, "target", pairs)


def grouped_metrics(df: DataFrame, by: Sequence[str], label: str, prediction: str) -> DataFrame:
    """n, RMSE and R2 per group of rows; rows without a label or prediction do not count."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label).cast("double"))
    error = y - F.col(prediction).cast("double")
    sums = df.groupBy(*by).agg(F.count(y).alias("n"), F.sum(error * error).alias("_res"), F.var_pop(y).alias("_var"))
    total = F.col("_var") * F.col("n")
    r2 = F.when(total > 0, 1 - F.col("_res") / total).when(F.col("_res") == 0, 1.0).when(F.col("_res") > 0, 0.0)
    return sums.select(*by, "n", F.when(F.col("n") > 0, F.sqrt(F.col("_res") / F.col("n"))).alias("rmse"), r2.alias("r2"))


def model_comparison(df: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """RMSE and R2 per model; ``predictions`` maps a model to its prediction column."""
    return _metrics(df, "model", {model: (label, column) for model, column in predictions.items()})
