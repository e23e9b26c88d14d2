"""Fixed-length row sequences per station and their ordered split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ROWS_PER_BLOCK, running_total, with_row_frames
from .features import STATION

LENGTH = 24
TRAIN, VALIDATION, TEST = "train", "val", "test"


def station_starts(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per station: its rows and how many sequences start in it."""
    return df.groupBy(*STATION).agg(F.count("*").alias("rows")).withColumn(
        "starts", F.greatest(F.col("rows") - (length - 1), F.lit(0))
    )


def sequence_starts(
    df: DataFrame,
    length: int = LENGTH,
    order: Sequence[str] = ("date",),
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rows that begin a full sequence, with their row number and the number of rows of the station."""
    return running_total(
        df, STATION, order, running="row_number", total="station_rows", rows_per_block=rows_per_block
    ).filter(F.col("row_number") <= F.col("station_rows") - (length - 1))


def sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    length: int = LENGTH,
    order: Sequence[str] = ("date",),
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Per start: ``length`` feature rows as nested arrays, and the target at the last of them."""

    def build(ordered):
        row = F.array(*[F.col(c).cast("double") for c in features])
        return {
            "sequence": F.collect_list(row).over(ordered.rowsBetween(0, length - 1)),
            "sequence_target": F.lead(target, length - 1).over(ordered),
        }

    return (
        with_row_frames(
            df.select(*dict.fromkeys([*STATION, *order, *features, target])),
            build, 0, length - 1, STATION, order, rows_per_block,
        )
        .filter(F.size("sequence") == length)
        .select(*STATION, *order, "sequence", F.col("sequence_target").alias(target))
    )


def _station_positions(df: DataFrame, length: int, train: float, validation: float, rows_per_block: int | None) -> DataFrame:
    """Per station: the starts before it in station order and where the train and validation parts end."""
    stations = running_total(
        station_starts(df, length), [], STATION, F.col("starts"),
        running="starts_up_to", total="all_starts", rows_per_block=rows_per_block,
    )
    return stations.select(
        *STATION,
        "starts",
        (F.col("starts_up_to") - F.col("starts")).alias("starts_before"),
        F.floor(F.col("all_starts") * F.lit(train).cast("double")).alias("train_end"),
        F.floor(F.col("all_starts") * F.lit(validation).cast("double")).alias("validation_end"),
    )


def numbered_rows(
    df: DataFrame,
    length: int = LENGTH,
    train: float = 0.70,
    validation: float = 0.85,
    order: Sequence[str] = ("date",),
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """All rows with ``row_number`` and ``station_rows``, and per station ``starts`` (how many sequences start in it),
    ``starts_before`` (in the stations before it), ``train_end`` and ``validation_end`` (last positions of the parts)."""
    return running_total(
        df, STATION, order, running="row_number", total="station_rows", rows_per_block=rows_per_block,
        per_group=_station_positions(df, length, train, validation, rows_per_block),
    )


def ordered_split(
    df: DataFrame,
    length: int = LENGTH,
    train: float = 0.70,
    validation: float = 0.85,
    order: Sequence[str] = ("date",),
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Sequence starts with their part of a split by position in (station, time) order.

    ``train`` and ``validation`` are the shares of starts that end each part; the rest is the test part.
    """
    ranked = numbered_rows(df, length, train, validation, order, rows_per_block)
    position = F.col("starts_before") + F.col("row_number")
    return (
        ranked.filter(F.col("row_number") <= F.col("starts"))
        .withColumn("position", position)
        .withColumn(
            "split",
            F.when(F.col("position") <= F.col("train_end"), TRAIN)
            .when(F.col("position") <= F.col("validation_end"), VALIDATION)
            .otherwise(TEST),
        )
        .drop("starts", "starts_before", "train_end", "validation_end")
    )


def train_rows(
    df: DataFrame,
    length: int = LENGTH,
    train: float = 0.70,
    validation: float = 0.85,
    order: Sequence[str] = ("date",),
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rows that belong to at least one training sequence.

    Training starts are the first ones of a station, so they cover its rows up to the last start plus the length.
    """
    positions = _station_positions(df, length, train, validation, rows_per_block).select(
        *STATION,
        F.least(F.greatest(F.col("train_end") - F.col("starts_before"), F.lit(0)), F.col("starts")).alias("_trained"),
    )
    ranked = running_total(
        df, STATION, order, running="_row_number", total="_rows", per_group=positions, rows_per_block=rows_per_block
    )
    covered = (F.col("_trained") > 0) & (F.col("_row_number") <= F.col("_trained") + (length - 1))
    return ranked.filter(covered).select(*df.columns)
