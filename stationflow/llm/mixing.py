"""Mix sources to target weights by Pareto order sampling.

1. Targets: the sources, in code-point order, get weights; a total is shared by weight, no source getting more than
   ``most`` times its size. The level at which it is shared is found by repeating one aggregate over the source table.
2. Every document is expected to be repeated target / size times, for its source. The whole part of that number is
   certain: all documents get so many copies.
3. The rest is one more copy of some documents. Each has an inclusion probability p and a random number u, both fixed
   by the document, and is ranked by the Pareto ratio (u / (1 - u)) / (p / (1 - p)). Documents are taken in rank order
   up to a fixed size in words, the rest of the target. One more, the one whose size comes closest to what is then
   still missing, closes the gap where that brings the source nearer to its target.

The probability differs between sources, and between documents where ``propensity`` is given. A document gets at most
one additional copy, so at most ``most`` in all.

One source may hold most rows: running sums are kept for ``CELLS`` ranges of rank per source, from partial aggregates,
and only the documents of the one range that the limit falls into are ordered one by one. What a document needs to know
is one row per source.

Null and empty texts have size 0 and no copy changes the mix. A null source is a source of its own, ordered last.
Repeated rows (same id, same text) have one rank and are taken or left together. No documents, no rows. Extra columns
pass through, except those named as the added ones, which are replaced. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 20_240_613
#: Ranges of rank per source; the limit falls into one of them.
CELLS = 65_536

_ADDED = ["size", "source_size", "target", "copies"]
_STEPS = 1 << 52


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_weights(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight`` to one row per source: ``weights``, repeating, by code point, null last."""
    # Sorted partitions, each numbered from 0; of the partitions only their row counts meet in one task.
    numbered = staged(
        totals.orderBy(F.asc_nulls_last("source")).withColumn("_id", F.monotonically_increasing_id()), "sources"
    ).withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    )
    place = F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return numbered.join(bases, "_part").select(
        *totals.columns, F.get(listed, (place % len(weights)).cast("int")).alias("weight")
    )


def share(sources: DataFrame, most: float = MOST) -> DataFrame:
    """Add ``target``: all sizes, shared by weight, at most ``most`` times a source's size.

    What exceeds a source's limit is shared again by weight among the others, until none is above.
    """
    cap = F.lit(float(most)) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap <= level * F.col("weight")
        row = sources.agg(F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("open"))
        capped, still_open = row.first()
        if not still_open:
            break
        higher = (total - (capped or 0.0)) / still_open
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def _limits(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: the last rank taken (``cut``) and the rank that closes the gap (``close``), null for none."""
    cells = ranked.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    # The first range that ends beyond the rest of the target.
    cell = (
        cells.withColumn("upto", F.sum("words").over(upto))
        .alias("c")
        .join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        .filter("upto > rest")
        .groupBy(F.col("s.source").alias("c_source"), "rest")
        .agg(F.min(F.struct("cell", "upto", "words")).alias("first"))
        .select("c_source", F.col("first.cell").alias("c_cell"), F.expr("rest - (first.upto - first.words)").alias("room"))
    )
    running = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        ranked.join(cell, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
        .withColumn("used", F.sum("size").over(running))
        .groupBy("source", "room", "cell")
        .agg(
            F.max(F.when(F.col("used") <= F.col("room"), F.struct("rank", "used"))).alias("last"),
        )
        # Nothing taken of this range: the cut lies before its first rank.
        .select(
            F.col("source").alias("c_source"),
            F.coalesce(
                "last.rank",
                F.struct((F.col("cell") / CELLS).alias("ratio"), F.lit(None).cast("bigint").alias("tie")),
            ).alias("cut"),
            (F.col("room") - F.coalesce("last.used", F.lit(0))).alias("gap"),
        )
    )
    inside = staged(inside, "cuts")
    miss = F.abs(F.col("gap") - F.col("size"))
    close = (
        ranked.join(inside, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("rank") > F.col("cut")))
        .filter(miss < F.col("gap"))
        .groupBy(F.col("source").alias("k_source"))
        .agg(F.min(F.struct(miss.alias("miss"), F.col("rank").alias("rank"))).alias("best"))
    )
    return inside.join(close, F.col("c_source").eqNullSafe(F.col("k_source")), "left").select(
        "c_source", "cut", F.col("best.rank").alias("close")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = SEED,
    propensity: Column | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix holds the document).

    ``propensity`` (above 0, at most 1) scales a document's chance of the additional copy.
    """
    kept = [c for c in docs.columns if c.lower() not in _ADDED]
    mixed = _mixed(docs, kept, weights, most, seed, propensity)
    return mixed.select("row.*", "size", "source_size", "target", "copies")


def _mixed(
    docs: DataFrame,
    columns: list[str],
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = SEED,
    propensity: Column | None = None,
) -> DataFrame:
    """The named columns in one column ``row``, beside what the mix knows of each document, so no names clash."""
    wish = F.lit(1.0) if propensity is None else F.coalesce(propensity.cast("double"), F.lit(1.0))
    chance = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(_STEPS)) + 0.5) / _STEPS
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = docs.select(
        row, F.col("source"), words(F.col("text")).alias("size"), chance.alias("u"), wish.alias("wish"),
        F.xxhash64("text", "doc_id").alias("tie"),
    )
    slim = staged(rows.drop("row"), "sizes")
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(share(source_weights(totals, weights), most), "targets")
    ratio = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    plan = targets.select(
        F.col("source").alias("s_source"), "source_size", "target", F.floor(ratio).alias("whole"),
        (ratio - F.floor(ratio)).alias("part"), F.round(F.col("target") - F.floor(ratio) * F.col("source_size")).cast("bigint").alias("rest"),
    )

    def ranked(df: DataFrame) -> DataFrame:
        p = F.greatest(F.least(F.col("part") * F.col("wish"), F.lit(1 - 1e-9)), F.lit(1e-9))
        pareto = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
        at = pareto / (1 + pareto)
        return df.join(plan, F.col("source").eqNullSafe(F.col("s_source"))).withColumns(
            {"rank": F.struct(at.alias("ratio"), F.col("tie")), "cell": F.floor(at * CELLS).cast("int")}
        )

    wanted = plan.filter("rest > 0").select(F.col("s_source").alias("source"), "rest")
    limits = staged(_limits(ranked(slim).filter("rest > 0 and size > 0"), wanted), "limits")
    one_more = F.coalesce(F.col("rank") <= F.col("cut"), F.lit(False)) | F.coalesce(
        F.col("rank") == F.col("close"), F.lit(False)
    )
    # Without a cut nothing of the source's ranks lies beyond the rest: all are taken, or there is no rest.
    extra = F.when(F.col("cut").isNull(), F.col("rest") > 0).otherwise(one_more)
    return (
        ranked(rows)
        .join(limits, F.col("source").eqNullSafe(F.col("c_source")), "left")
        .select("row", "size", "source_size", "target", (F.col("whole") + extra.cast("bigint")).alias("copies"))
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as the mix holds it, with all its columns as they are."""
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return _mixed(docs, docs.columns, **options).filter("copies > 0").select("row", again).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    mixed = mix(docs.select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
