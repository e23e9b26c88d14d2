"""Fixed-length sequences as slices of chunks, so that a cell is stored about once.

A chunk holds ``chunk_rows`` consecutive rows of a station and the ``length - 1`` rows behind them, so every sequence that
starts in the chunk lies in it. Its cells are one row-major array of floats; a sequence is a slice of that array, and a
sequence's target is the one of its last row. Overlapping rows are the only cells that are stored twice: 23 of 1,047 with
the defaults, where one array per sequence stores every cell 24 times.

Chunks are cut by the row number, so a station of any size makes chunks of bounded size: ``chunk_rows + length - 1`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import ROWS_PER_BLOCK
from .features import STATION
from .sequences import LENGTH, TEST, TRAIN, VALIDATION, numbered_rows

CHUNK_ROWS = 1024


@dataclass(frozen=True)
class SequenceLayout:
    """What a store's arrays hold: the features of a row, in order, and the rows of a sequence."""

    features: tuple[str, ...]
    target: str
    length: int = LENGTH

    @property
    def cells(self) -> int:
        return self.length * len(self.features)


def _split_of(position: Column) -> Column:
    return (
        F.when(position <= F.col("train_end"), TRAIN)
        .when(position <= F.col("validation_end"), VALIDATION)
        .otherwise(TEST)
    )


def sequence_chunks(
    df: DataFrame,
    layout: SequenceLayout,
    train: float = 0.70,
    validation: float = 0.85,
    order: Sequence[str] = ("date",),
    chunk_rows: int = CHUNK_ROWS,
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row per chunk that has a start.

    ``cells`` (row-major floats), ``targets`` and ``dates`` (one per row), ``starts`` (sequences that start here; the first
    ones of the chunk's rows), ``first_position`` (of the first start among all starts in (station, time) order, from 1),
    ``train_end`` and ``validation_end`` (the last position of these parts).

    Stations with fewer rows than a sequence have no chunk. ``order`` should be unique within a station.
    """
    if chunk_rows < 1:
        raise ValueError("a chunk needs at least one row")
    numbered = numbered_rows(df, layout.length, train, validation, order, rows_per_block).filter("starts > 0")
    row = F.col("row_number") - 1
    own = F.floor(row / chunk_rows)
    # The first rows of a chunk also end the sequences that start in the one before (or in several, if chunks are short).
    earliest = F.greatest(F.floor((row - (layout.length - 1)) / chunk_rows), F.lit(0))
    last_chunk = F.floor((F.col("starts") - 1) / chunk_rows)
    # Rows behind the last start belong to the chunks before them.
    dealt = numbered.withColumn("chunk", F.explode(F.sequence(earliest, F.least(own, last_chunk))))
    values = F.array(*[F.col(c).cast("float") for c in layout.features])
    held = F.struct("row_number", F.col(order[0]).alias("date"), F.col(layout.target).cast("float").alias("target"), values.alias("v"))
    fixed = ["starts", "starts_before", "train_end", "validation_end"]
    grouped = dealt.groupBy(*STATION, "chunk").agg(
        F.sort_array(F.collect_list(held)).alias("rows"), *[F.first(c).alias(c) for c in fixed]
    )
    first = F.col("chunk") * chunk_rows
    return grouped.select(
        *STATION,
        "chunk",
        F.flatten(F.col("rows.v")).alias("cells"),
        F.col("rows.target").alias("targets"),
        F.col("rows.date").alias("dates"),
        F.least(F.col("starts") - first, F.lit(chunk_rows)).cast("int").alias("starts"),
        (F.col("starts_before") + first + 1).alias("first_position"),
        "train_end",
        "validation_end",
    )


def sequence_index(chunks: DataFrame) -> DataFrame:
    """One row per sequence: where it starts (chunk and ``offset`` in it), its date, position and split. No cells."""
    slim = chunks.drop("cells", "targets")
    listed = slim.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("starts") - 1)))
    return listed.withColumn("position", F.col("first_position") + F.col("offset")).select(
        *STATION,
        "chunk",
        "offset",
        F.get("dates", F.col("offset")).alias("date"),
        "position",
        _split_of(F.col("position")).alias("split"),
    )


def stored_sequences(chunks: DataFrame, layout: SequenceLayout, split: str | None = None) -> DataFrame:
    """All sequences, or those of one part: ``sequence`` (row-major floats) and ``target``. Slices, without a shuffle."""
    listed = chunks.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("starts") - 1)))
    listed = listed.withColumn("position", F.col("first_position") + F.col("offset"))
    listed = listed.withColumn("split", _split_of(F.col("position")))
    if split is not None:
        listed = listed.filter(F.col("split") == split)
    width = len(layout.features)
    return listed.select(
        *STATION,
        F.get("dates", F.col("offset")).alias("date"),
        "position",
        "split",
        F.slice("cells", F.col("offset") * width + 1, layout.cells).alias("sequence"),
        F.get("targets", F.col("offset") + (layout.length - 1)).alias("target"),
    )
