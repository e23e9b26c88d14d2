"""Stored predictions of several models, and their metrics side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matrix import IDENTIFIERS, drop_null_targets, hash_split
from ..operators.metrics import grouped_metrics
from ..schemas import TARGET_NAMES
from ..sources import read_dataset, write_parquet
from .training import Models

TRAINED = "gbt"


def validation_predictions(dataset: DataFrame, models: Models, target: str, naive: dict[str, str]) -> DataFrame:
    """Station, date, model, label and prediction of every validation row of the training, one row per model.

    The trained model of ``target`` stands beside the ``naive`` ones, whose predictions are columns of the dataset.
    One pass over the rows: the models' columns are turned into rows in place.
    """
    rows = hash_split(drop_null_targets(dataset)).filter(F.col("split") == "validation").drop("split")
    keys = {c: f"_{c}" for c in IDENTIFIERS}
    kept = {f"_model_{m}": F.col(c).cast("double") for m, c in naive.items()}
    held = rows.withColumns({**{k: F.col(c) for c, k in keys.items()}, "_label": F.col(target).cast("double"), **kept})
    scored = models.whole(target).transform(held).withColumnRenamed(f"{TARGET_NAMES[target]}_prediction", f"_model_{TRAINED}")
    names = [f"_model_{TRAINED}", *kept]
    long = scored.unpivot([*keys.values(), "_label"], names, "model", "prediction")
    return long.select(
        *[F.col(k).alias(c) for c, k in keys.items()],
        F.lit(target).alias("target"),
        F.regexp_replace("model", "^_model_", "").alias("model"),
        F.col("_label").alias("label"),
        "prediction",
    )


def store_predictions(predictions: DataFrame, path: str) -> DataFrame:
    """Write predictions, one folder per model, and read them back. Models are added to or replaced in what is there."""
    predictions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)
    return predictions.sparkSession.read.parquet(path)


def compare_stored(spark: SparkSession, path: str) -> DataFrame:
    """model, n, rmse and r2 of all stored predictions; an error if there are none."""
    return grouped_metrics(read_dataset(spark, path), ["model"], "label", "prediction")
