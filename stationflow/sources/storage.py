"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the session's ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting only a session in one process gets a folder of its own; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stationflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_WHOLE_STAGE = "spark.sql.codegen.wholeStage"


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Actions on rows of some fifty columns run operator by operator meanwhile.

    A stage of such rows becomes one generated method of more than the 8,000 bytes that the JVM compiles, so it would be
    interpreted. Each operator's own code is split into small methods. Results are the same.
    """
    before = spark.conf.get(_WHOLE_STAGE)
    spark.conf.set(_WHOLE_STAGE, "false")
    try:
        yield
    finally:
        spark.conf.set(_WHOLE_STAGE, before)


def staged(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    compression: str | None = None,
    wide: bool = False,
) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: what follows survives lost executors without going back to the sources, and reads columns
    instead of text. ``compression`` is a Parquet codec in place of the session's; ``wide`` writes as in :func:`wide_rows`.
    """
    path = shared_dir(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with wide_rows(df.sparkSession) if wide else nullcontext():
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
