"""One gradient-boosted regressor per target, on scaled features and targets."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matrix import drop_null_targets, hash_split, to_float32
from ..operators.metrics import regression_metrics
from ..schemas import TARGET_NAMES, TARGETS
from ..sources import staged, wide_rows, write_metrics, write_parquet
from .preparation import PopulationScaler, PopulationScalerModel, fit_inputs

SEED = 42
VECTOR = "features"


class Models(dict):
    """A fitted regressor per target (model, then its target's scale undone) behind one shared preparation.

    ``preparation`` goes from unencoded inputs to the scaled vector that every regressor reads.
    """

    def __init__(self, regressors: dict[str, PipelineModel] | None = None, preparation: PipelineModel | None = None):
        super().__init__(regressors or {})
        self.preparation = preparation

    def whole(self, target: str) -> PipelineModel:
        """Preparation and regressor of a target as one model."""
        return PipelineModel([*self.preparation.stages, *self[target].stages])


def scaled_name(target: str) -> str:
    return f"{target}_scaled"


def training_frame(
    dataset: DataFrame, inputs: tuple[PipelineModel, list[str]] | None = None
) -> tuple[DataFrame, list[str]]:
    """Prepared features and targets with a ``split`` column, and the feature columns.

    ``inputs`` are those of :func:`fit_inputs`, learned from the dataset itself by default.
    """
    labelled = drop_null_targets(dataset)
    stages, features = inputs or fit_inputs(labelled)
    frame = to_float32(stages.transform(hash_split(labelled)), TARGETS)
    return frame.select(*features, *TARGETS, "split"), features


def train_target(
    frame: DataFrame, scaler: PopulationScalerModel, target: str, iterations: int = 20, depth: int = 5
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training part; returns the regressor and its metrics on the validation part, in the target's units.

    ``frame`` has the feature vector, the targets, their scaled forms and ``split``.
    """
    name = TARGET_NAMES[target]
    prediction = f"{name}_prediction"
    regressor = GBTRegressor(
        featuresCol=VECTOR, labelCol=scaled_name(target), predictionCol=prediction,
        maxIter=iterations, maxDepth=depth, seed=SEED,
    )
    fitted = regressor.fit(frame.filter(F.col("split") == "train").select(VECTOR, scaled_name(target)))
    model = PipelineModel([fitted, scaler.unscaler(target, prediction)])
    scored = model.transform(frame.filter(F.col("split") == "validation").select(VECTOR, target))
    return model, regression_metrics(scored, {name: (target, prediction)})


def prepared_vectors(dataset: DataFrame) -> tuple[DataFrame, PipelineModel, PopulationScalerModel]:
    """The stored training table, the fitted preparation and the fitted scaler of the targets.

    Levels and medians come from all labelled rows, means and deviations from the training part.
    """
    inputs, features = fit_inputs(drop_null_targets(dataset))
    frame = staged(training_frame(dataset, (inputs, features))[0], "training_rows", wide=True)
    trained = frame.filter(F.col("split") == "train")
    with wide_rows(dataset.sparkSession):
        scaler = PopulationScaler(inputCols=features).fit(trained)
    target_scaler = PopulationScaler(inputCols=list(TARGETS)).fit(trained)
    assembler = VectorAssembler(inputCols=features, outputCol=VECTOR)
    vectors = assembler.transform(scaler.transform(frame)).select(VECTOR, *TARGETS, "split")
    labels = vectors.withColumns({scaled_name(t): F.col(t) for t in TARGETS})
    renamed = PopulationScalerModel(
        inputCols=[scaled_name(t) for t in TARGETS],
        stats={f"{scaled_name(t)}_{s}": v for t in TARGETS for s, v in zip(("mean", "std"), target_scaler.of(t), strict=True)},
    )
    table = staged(renamed.transform(labels), "training", partition_by=["split"], wide=True)
    return table, PipelineModel([*inputs.stages, scaler, assembler]), target_scaler


def train_all(
    dataset: DataFrame, targets: Sequence[str] = TARGETS, iterations: int = 20, depth: int = 5
) -> tuple[Models, DataFrame] | None:
    """A regressor per target and the metrics of all; None when there are no rows.

    The regressors are trained at the same time from one stored table, so the jobs of one fill the gaps of the others.
    """
    if dataset.isEmpty():
        return None
    frame, preparation, scaler = prepared_vectors(dataset)

    def one(target: str) -> tuple[PipelineModel, DataFrame]:
        return train_target(frame, scaler, target, iterations, depth)

    with ThreadPoolExecutor(max(1, len(targets))) as pool:
        trained = list(pool.map(inheritable_thread_target(dataset.sparkSession)(one), targets))
    models = Models(dict(zip(targets, (m for m, _ in trained), strict=True)), preparation)
    metrics = trained[0][1]
    for _, measured in trained[1:]:
        metrics = metrics.unionByName(measured)
    return models, metrics


def save_model(models: Models, metrics: DataFrame, output_dir: str) -> None:
    """Preparation, regressors, and metrics as Parquet and as text lines."""
    models.preparation.write().overwrite().save(f"{output_dir}/models/preparation")
    for target, model in models.items():
        model.write().overwrite().save(f"{output_dir}/models/{TARGET_NAMES[target]}")
    write_parquet(metrics, f"{output_dir}/metrics.parquet")
    write_metrics(metrics.sparkSession.read.parquet(f"{output_dir}/metrics.parquet"), f"{output_dir}/metrics.txt")


def load_model(spark: SparkSession, output_dir: str, targets: Sequence[str] = TARGETS) -> Models:
    regressors = {t: PipelineModel.load(f"{output_dir}/models/{TARGET_NAMES[t]}") for t in targets}
    return Models(regressors, PipelineModel.load(f"{output_dir}/models/preparation"))
