"""Fitted preparation of model inputs as Spark ML stages that are saved with the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..operators.matrix import IDENTIFIERS, data_categories, drop_columns, one_hot, scaler_fit, standard_scale, to_float32
from ..operators.medians import exact_medians, fill_with
from ..operators.scalars import one_row
from ..schemas import TARGETS


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Parameters are kept as JSON, which gives back every double as it was."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)


class _OnColumns(_Stage):
    inputCols = Param(Params._dummy(), "inputCols", "columns to work on", TypeConverters.toListString)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class CategoryEncoder(_Stage, Estimator):
    """Learns the levels of the categorical columns."""

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        return CategoryEncoderModel(levels=data_categories(dataset))


class CategoryEncoderModel(_Stage, Model):
    """One 0/1 column per learned level; a level not seen in fitting, or null, sets none of them."""

    levels = Param(Params._dummy(), "levels", "ordered levels of each categorical column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return one_hot(dataset, self.getOrDefault(self.levels))


class MedianFiller(_OnColumns, Estimator):
    """Learns the interpolated median of each column."""

    def _fit(self, dataset: DataFrame) -> MedianFillerModel:
        return MedianFillerModel(medians=exact_medians(dataset, self.columns()).first().asDict())


class MedianFillerModel(_Stage, Model):
    """Fills nulls and NaN with the learned medians; a column without values in fitting stays as it is."""

    medians = Param(Params._dummy(), "medians", "median of each column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fill_with(dataset, _constants(dataset, self.getOrDefault(self.medians)))


class Float32Caster(_OnColumns, Transformer):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return to_float32(dataset, self.columns())


class PopulationScaler(_OnColumns, Estimator):
    """Learns mean and population deviation of each column; a constant column has deviation 1."""

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        return PopulationScalerModel(inputCols=self.columns(), stats=scaler_fit(dataset, self.columns()).first().asDict())


class PopulationScalerModel(_OnColumns, Model):
    """``(x - mean) / deviation`` of each column, as floats."""

    stats = Param(Params._dummy(), "stats", "<column>_mean and <column>_std of each column")

    def of(self, column: str) -> tuple[float, float]:
        stats = self.getOrDefault(self.stats)
        return stats[f"{column}_mean"], stats[f"{column}_std"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self.columns()
        stats = _constants(dataset, self.getOrDefault(self.stats))
        return to_float32(standard_scale(dataset, stats, columns), columns)

    def unscaler(self, target: str, prediction: str) -> Unscaler:
        """The stage that brings a model's output for a scaled target back to the target's own units."""
        mean, deviation = self.of(target)
        return Unscaler(column=prediction, mean=mean, deviation=deviation)


class Unscaler(_Stage, Transformer):
    """``x * deviation + mean`` of one column, in place."""

    column = Param(Params._dummy(), "column", "column to restore", TypeConverters.toString)
    mean = Param(Params._dummy(), "mean", "mean of the target", TypeConverters.toFloat)
    deviation = Param(Params._dummy(), "deviation", "deviation of the target", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.column)
        restored = F.col(name) * F.lit(self.getOrDefault(self.deviation)) + F.lit(self.getOrDefault(self.mean))
        return dataset.withColumn(name, restored)


def _constants(dataset: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return one_row(dataset.sparkSession, values, StructType([StructField(c, DoubleType()) for c in values]))


def fit_inputs(labelled: DataFrame, targets: Sequence[str] = TARGETS, keep: Sequence[str] = ()) -> tuple[PipelineModel, list[str]]:
    """Levels, medians and the cast to float32, learned from all labelled rows, and the ordered feature columns.

    Every column is a feature but identifiers, ``targets`` and ``keep``.
    """
    rows = drop_columns(labelled, [c for c in (*IDENTIFIERS, *targets, *keep)])
    encoder = CategoryEncoder().fit(rows)
    encoded = encoder.transform(rows)
    filler = MedianFiller(inputCols=encoded.columns).fit(encoded)
    return PipelineModel([encoder, filler, Float32Caster(inputCols=encoded.columns)]), encoded.columns
