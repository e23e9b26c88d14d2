"""Input tables and intermediate tables of the text operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import shared_dir, staged

__all__ = ["DOCUMENT_COLUMNS", "read", "shared_dir", "ship", "shuffle_partitions", "slices", "small_broadcasts", "staged"]

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers of this application import the package, also where it is not installed.

    The driver hands Spark an archive of the package, which Spark gives to every executor.
    """
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(root) in on_path or context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1].name
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp()) / package), "zip", root, package)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


#: Settings with their defaults and smaller values: bytes of an Arrow batch, rows of a batch that is read from Parquet.
BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": (f"{64 << 20}b", str(1 << 20)),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions meanwhile read and pass texts in smaller batches, so that these fill less of an executor's memory.

    Settings other than the defaults stay. Results are the same.
    """
    changed = {name: small for name, (default, small) in BATCHES.items() if spark.conf.get(name) == default}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, small in changed.items():
            spark.conf.set(name, small)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Most bytes of a table, by Spark's estimate, that a join sends whole to every task.
BROADCAST_BYTES = 256 << 10
_BROADCASTS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")  # the second may be unset


@contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins of actions meanwhile broadcast tables of at most ``BROADCAST_BYTES``, unless the query names one itself.

    The driver fetches, builds and keeps what is broadcast. Spark judges a stored table by its compressed files: 10 MB, the
    default, can be two million rows of ids, which take it hundreds of MB. Smaller settings stay. Results are the same.
    """
    fixed, adaptive = _BROADCASTS
    before = {fixed: spark.conf.get(fixed)} | ({adaptive: value} if (value := spark.conf.get(adaptive, None)) else {})
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    changed = [name for name, value in before.items() if not value.startswith("-") and in_bytes(value) > BROADCAST_BYTES]
    try:
        for name in changed:
            spark.conf.set(name, str(BROADCAST_BYTES))
        yield
    finally:
        for name in changed:
            spark.conf.set(name, before[name])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) ranges of items whose sizes add up to at most ``most``; a larger item stands alone."""
    start, end, total = 0, 0, 0
    for size in sizes:
        if end > start and total + size > most:
            yield start, end
            start, total = end, 0
        total += size
        end += 1
    if end > start:
        yield start, end


def utf8(column) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is an empty text."""
    import pyarrow as pa

    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(binary).to_pylist()]
