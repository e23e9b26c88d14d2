"""Predictions for snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aqi_alert, aqi_level
from ..operators.matrix import inverse_scale
from ..operators.snapshot import snapshot_inputs
from ..schemas import TARGET_NAMES, TARGETS
from .training import Models


def predictions(snapshots: DataFrame, models: Models, keep: Sequence[str] = (), targets: Sequence[str] = TARGETS) -> DataFrame:
    """``keep`` columns and a prediction per target, by the stored preparation, regressors and target scales.

    A target without a model has null predictions, so the columns do not depend on what was trained.
    """
    names = {target: f"{TARGET_NAMES[target]}_prediction" for target in targets}
    scored = snapshot_inputs(snapshots, tuple(keep))
    if models:
        scored = models.preparation.transform(scored)
    for model in models.values():
        scored = model.transform(scored)
    scored = scored.withColumns({p: F.lit(None).cast("double") for t, p in names.items() if t not in models})
    return scored.select(*keep, *names.values())


def batch_predict(
    snapshots: DataFrame,
    models: Models,
    keep: tuple[str, ...] = (),
    target_scaler: DataFrame | None = None,
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    """``keep`` columns, the three predictions, and the health band and alert flag of each.

    Levels, medians and scales are those stored with the models. ``target_scaler`` (one row of statistics) is for regressors
    whose output is still scaled.
    """
    names = {target: f"{TARGET_NAMES[target]}_prediction" for target in targets}
    scored = predictions(snapshots, models, keep, targets)
    if target_scaler:
        back = inverse_scale(scored.withColumnsRenamed({p: t for t, p in names.items()}), target_scaler, list(names))
        scored = back.withColumnsRenamed(names)
    levels = {f"{TARGET_NAMES[t]}_level": aqi_level(p, F.col(p)) for t, p in names.items()}
    alerts = {f"{TARGET_NAMES[t]}_alert": aqi_alert(F.col(f"{TARGET_NAMES[t]}_level")) for t in names}
    return scored.withColumns(levels).withColumns(alerts)
