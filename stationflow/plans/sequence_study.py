"""From the dataset to scaled, split sequences: the inputs of sequence models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import ROWS_PER_BLOCK
from ..operators.features import STATION
from ..operators.matrix import IDENTIFIERS, finite_only, one_hot, scaler_fit, standard_scale, to_float32
from ..operators.scalars import evaluated
from ..operators.sequence_store import CHUNK_ROWS, SequenceLayout, sequence_chunks, stored_sequences
from ..operators.sequences import LENGTH, train_rows
from ..schemas import TARGETS
from ..sources import staged, wide_rows, write_parquet

STUDY_TARGET = "o3_next_24h_max"


@dataclass(frozen=True)
class SequenceStudy:
    """Chunks of scaled rows, what their arrays hold, and the means and deviations behind the scaling (one row)."""

    layout: SequenceLayout
    chunks: DataFrame
    stats: DataFrame

    def sequences(self, split: str | None = None) -> DataFrame:
        """All sequences with their scaled target, or those of one part."""
        return stored_sequences(self.chunks, self.layout, split)


def study_rows(
    dataset: DataFrame, target: str = STUDY_TARGET, categories: dict[str, Sequence[str] | None] | None = None
) -> tuple[DataFrame, list[str]]:
    """Station, date and float32 features and target of the rows that have all of them, and the ordered features.

    Every column is a feature but identifiers and targets; city and season are encoded. NaN and infinities count as missing.
    """
    encoded = one_hot(dataset.dropna(subset=[target]), categories)
    features = [c for c in encoded.columns if c not in (*IDENTIFIERS, *TARGETS, target)]
    numbers = [*features, target]
    rows = to_float32(encoded.select(*STATION, "date", *numbers), numbers)
    return finite_only(rows, numbers).dropna(subset=numbers), features


def sequence_study(
    dataset: DataFrame,
    target: str = STUDY_TARGET,
    length: int = LENGTH,
    train: float = 0.70,
    validation: float = 0.85,
    categories: dict[str, Sequence[str] | None] | None = None,
    chunk_rows: int = CHUNK_ROWS,
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> SequenceStudy:
    """Clean rows, split by position of sequence starts, scaled by the rows of the training sequences, in chunks.

    Dates should be unique within a station. Scaling uses population deviations, 1 for a constant column; without a
    training sequence the statistics, and so all cells, are null.
    """
    rows, features = study_rows(dataset, target, categories)
    rows = staged(rows, "study_rows", wide=True)
    layout = SequenceLayout(tuple(features), target, length)
    numbers = [*features, target]
    trained = train_rows(rows, length, train, validation, rows_per_block=rows_per_block)
    with wide_rows(dataset.sparkSession):
        stats = evaluated(scaler_fit(trained, numbers))
    scaled = to_float32(standard_scale(rows, stats, numbers), numbers)
    chunks = sequence_chunks(scaled, layout, train, validation, chunk_rows=chunk_rows, rows_per_block=rows_per_block)
    return SequenceStudy(layout, chunks, stats)


def write_study(study: SequenceStudy, path: str) -> SequenceStudy:
    """Store chunks, layout and statistics below ``path``; returns the stored study."""
    spark = study.chunks.sparkSession
    write_parquet(study.chunks, f"{path}/chunks.parquet")
    write_parquet(study.stats, f"{path}/stats.parquet")
    layout = study.layout
    schema = "features array<string>, target string, length int"
    described = spark.createDataFrame([(list(layout.features), layout.target, layout.length)], schema)
    write_parquet(described, f"{path}/layout.parquet")
    return read_study(spark, path)


def read_study(spark: SparkSession, path: str) -> SequenceStudy:
    row = spark.read.parquet(f"{path}/layout.parquet").first()
    layout = SequenceLayout(tuple(row["features"]), row["target"], row["length"])
    return SequenceStudy(layout, spark.read.parquet(f"{path}/chunks.parquet"), spark.read.parquet(f"{path}/stats.parquet"))


def cell_digest(sequence: str = "sequence", modulus: int = 1009, factor: int = 7919) -> F.Column:
    """Sum of all cells of an array, each with a weight of its own place, so that no two cells can change places unseen."""

    def weighted(value: F.Column, place: F.Column) -> F.Column:
        return value.cast("double") * ((place + 1) * factor % modulus) / F.lit(float(modulus))

    return F.aggregate(F.transform(sequence, weighted), F.lit(0.0), lambda a, v: a + v)
