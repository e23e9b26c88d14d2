"""The pipeline as a command: sources to models, step by step."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.features import drop_nulls
from ..schemas import RAW_SCHEMA, default_sources
from ..session import get_session
from ..sources import RAW_TABLE, connection_properties, create_tables, read_dataset, replace_cities, write_jdbc, write_parquet
from .etl import load_and_unify
from .ml_dataset import ml_features, write_ml_dataset
from .training import save_model, train_all

STEPS = ("etl", "features", "train")
log = logging.getLogger("stationflow")


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the write instead of in a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_etl(
    spark: SparkSession, data_dir: str, output_dir: str, jdbc: dict[str, str] | None = None, catalog: bool = False
) -> str:
    path = f"{output_dir}/raw_air_quality.parquet"
    counted, seen = _counted(load_and_unify(spark, default_sources(data_dir)), "etl")
    write_parquet(counted, path)
    log.info("etl: %s rows", seen.get["rows"])
    if jdbc:
        write_jdbc(read_dataset(spark, path), RAW_TABLE, jdbc)
    if catalog:
        create_tables(spark, {RAW_TABLE: RAW_SCHEMA})
        replace_cities(read_dataset(spark, path), RAW_TABLE)
    return path


def run_features(
    spark: SparkSession, output_dir: str, jdbc: dict[str, str] | None = None, catalog: bool = False
) -> DataFrame:
    raw = read_dataset(spark, f"{output_dir}/raw_air_quality.parquet")
    before, seen_before = _counted(ml_features(raw), "features, all rows")
    after, seen_after = _counted(drop_nulls(before), "features, complete rows")
    written = write_ml_dataset(after, output_dir, jdbc=jdbc, catalog=catalog)
    rows, kept = seen_before.get["rows"], seen_after.get["rows"]
    log.info("features: %s rows before dropping nulls, %s after (%.2f %% dropped)", rows, kept, 100 * (rows - kept) / max(1, rows))
    return written


def run_training(spark: SparkSession, output_dir: str) -> bool:
    trained = train_all(read_dataset(spark, f"{output_dir}/ml_air_quality.parquet"))
    if trained is None:
        log.warning("train: no rows, skipped")
        return False
    save_model(*trained, output_dir)
    return True


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=list(STEPS))
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--jdbc", action="store_true", help="also write both tables to the database in the environment")
    parser.add_argument("--catalog", action="store_true", help="also replace the cities read in the catalog's two tables")
    chosen = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)

    spark = get_session()
    jdbc = connection_properties() if chosen.jdbc else None
    if "etl" in chosen.steps:
        run_etl(spark, chosen.data_dir, chosen.output_dir, jdbc, chosen.catalog)
    if "features" in chosen.steps:
        run_features(spark, chosen.output_dir, jdbc, chosen.catalog)
    if "train" in chosen.steps:
        run_training(spark, chosen.output_dir)
