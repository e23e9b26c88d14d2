"""Sources to the canonical table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean, unify_sources
from ..schemas import SourceSpec
from ..sources import read_source, staged


def load_sources(spark: SparkSession, specs: Sequence[SourceSpec], infer: bool = False) -> DataFrame:
    """Read and unify the sources, without filling or dropping anything."""
    return unify_sources([(spec, read_source(spark, spec, infer)) for spec in specs])


def load_and_unify(
    spark: SparkSession, specs: Sequence[SourceSpec], accuracy: int | None = None, stage: bool = True
) -> DataFrame:
    """Read, unify and clean the sources.

    Cleaning needs a ratio and medians over the whole data, so it reads its input several times; with ``stage``
    the text is parsed once into Parquet first.
    """
    unified = load_sources(spark, specs)
    return clean(staged(unified, "unified") if stage else unified, accuracy)
