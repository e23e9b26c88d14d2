"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before wrote as Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import mixing, odd_sketch, packing, pii, toxicity
from stationflow.llm.tables import free_name, read, staged


#: Settings with their defaults and what the stages use: bytes of an Arrow batch, rows of a batch that is read from Parquet.
_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": (f"{64 << 20}b", str(1 << 20)),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
}


def _small_batches(spark: SparkSession) -> None:
    """Smaller batches than the defaults, so that long texts fill less of an executor's memory: its JVM holds a batch of
    texts as one array, which grows by doubling, and its Python workers outlive the stages. Other settings stay."""
    for setting, (default, small) in _BATCHES.items():
        if spark.conf.get(setting) == default:
            spark.conf.set(setting, small)


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; empty texts stay."""
    _small_batches(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    name = free_name(docs, "score")
    return toxicity.score(docs, model, name=name).filter(F.col(name) < 0.5).drop(name)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _small_batches(spark)
    return odd_sketch.deduplicate(docs)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    _small_batches(spark)
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix holds them."""
    _small_batches(spark)
    return mixing.mixed_rows(docs)


def sequences_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    _small_batches(spark)
    return packing.query(docs)


STAGES = [
    ("toxicity", toxic_documents_out),
    ("near_dedup", near_duplicates_out),
    ("pii", personal_data_out),
    ("mixing", sources_mixed),
    ("packing", sequences_packed),
]

#: Tokens and trained dictionaries are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written before the next stage."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
