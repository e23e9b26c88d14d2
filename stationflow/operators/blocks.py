"""Ordered work on groups of any size.

A window over a whole group runs in one task, so a station holding a third of the data would hold up the job.
Here large groups are cut into *blocks* that follow the order of the group:

* about one row in ``rows_per_block`` is picked by a hash of its order key, and the group is cut before it.
  The choice depends on the row alone, so every run and every retried task cuts at the same places, and
  there are only about (rows / rows_per_block) cuts in all: few enough to look at in the driver and to broadcast.
  Tables of more than ``rows_per_block * MAX_CUTS / 2`` rows get longer blocks, by their number of rows.
* each row finds its block map-side, so rows move once, by (group, block).

Without a cut, as in any table of moderate groups, the plan is the plain window: one shuffle, one sort.

Finding the cuts is a job of its own that reads the key columns, so the input should be a stored table rather than
a costly query (see ``sources.staged``). Order keys should be unique within a group: rows with equal keys always share
a block, and their relative order is as undefined as in any window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 2_000_000
MAX_CUTS = 500_000

BLOCK = "_block"
LAST_BLOCK = "_last_block"


def find_cuts(
    df: DataFrame, group: Sequence[str], order: Sequence[str], rows_per_block: int, max_cuts: int = MAX_CUTS
) -> list[Row]:
    """Group and order keys of the rows before which a group is cut."""
    keys = df.select(*group, *order)
    # The rate is chosen once, from the number of rows: far below ``max_cuts`` keys are expected. Whether a key is
    # picked is a matter of its hash, so a limit is not needed for the result, only to fail early on a bad hash.
    rate = max(rows_per_block, -(-2 * keys.count() // max_cuts))
    picked = keys.filter(F.pmod(F.xxhash64(*keys.columns), F.lit(rate)) == 0).distinct()
    found = picked.limit(max_cuts + 1).collect()
    if len(found) > max_cuts:
        raise ValueError(f"more than {max_cuts} cuts at a rate of one in {rate} rows")
    return found


def with_blocks(
    df: DataFrame, cuts: list[Row], group: Sequence[str], order: Sequence[str], only_cut: bool = False
) -> DataFrame:
    """Add the block of each row and the last block of its group; ``only_cut`` keeps just the groups that are cut.

    The block is the number of cuts up to the row, found by halving: one comparison per step, all in generated code, so
    the sorted cuts of the group are looked at where they were broadcast and never copied into the row.
    """
    spark, schema = df.sparkSession, df.select(*group, *order).schema
    sorted_cuts = (
        spark.createDataFrame(cuts, schema)
        .groupBy(*[F.col(c).alias(f"_g_{c}") for c in group])
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))
    )
    same_group = [df[c].eqNullSafe(sorted_cuts[f"_g_{c}"]) for c in group]
    # At most MAX_CUTS keys on the broadcast side.
    found = df.join(F.broadcast(sorted_cuts), same_group, "inner" if only_cut else "left").select(
        *df.columns, "_cuts", F.struct(*order).alias("_key"), F.lit(0).alias(BLOCK)
    )
    for bit in reversed(range(len(cuts).bit_length())):
        # Beyond the end of the list, or without one, the comparison is null and the step is not taken.
        passed = F.get("_cuts", F.col(BLOCK) + (1 << bit) - 1) <= F.col("_key")
        found = found.withColumn(BLOCK, F.col(BLOCK) + F.when(passed, 1 << bit).otherwise(0))
    last = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size("_cuts"))
    return found.select(*df.columns, last.alias(LAST_BLOCK), BLOCK)


def with_row_frames(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int,
    group: Sequence[str],
    order: Sequence[str],
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    ``build`` gets a window specification and returns the columns. Each block is evaluated on its own. Only rows
    within ``before`` rows of a block's start or ``after`` rows of its end lack part of their frame; those are
    evaluated again over the rows next to the cuts, which is exact because (before + after) rows are kept on both
    sides. With None for ``rows_per_block`` groups stay whole.
    """
    whole = Window.partitionBy(*group).orderBy(*order)
    cuts = find_cuts(df, group, order, rows_per_block) if rows_per_block else []
    if not cuts:
        return df.withColumns(build(whole))

    in_block = Window.partitionBy(*group, BLOCK).orderBy(*order)

    def at_least(rows_before: int, rows_after: int) -> Column:
        block, last = F.col(BLOCK), F.col(LAST_BLOCK)
        enough_before = (block == 0) | F.lag(F.lit(1), rows_before).over(in_block).isNotNull()
        enough_after = (block == last) | F.lead(F.lit(1), rows_after).over(in_block).isNotNull()
        return enough_before & enough_after

    names = list(build(whole))
    columns = list(dict.fromkeys([*df.columns, *names]))
    complete = at_least(before, after)
    inner = (
        with_blocks(df, cuts, group, order)
        .withColumns({**build(in_block), "_complete": complete})
        .filter("_complete")
        .select(*columns)
    )
    reach = before + after
    near_cuts = (
        with_blocks(df, cuts, group, order, only_cut=True)
        .withColumns({"_complete": complete, "_far": at_least(reach, reach)})
        .filter("not _far")
    )
    repaired = near_cuts.withColumns(build(whole)).filter("not _complete").select(*columns)
    return inner.unionByName(repaired)


def _block_totals(blocked: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Per (group, block): the weight of the earlier blocks of the group and the weight of the whole group."""
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.groupBy(*group, BLOCK)
        .agg(F.sum(weight).alias("_weight"))
        .select(
            *group,
            BLOCK,
            F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_weight").over(Window.partitionBy(*group)).alias("_total"),
        )
    )


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    weight: Column | None = None,
    running: str = "running",
    total: str = "total",
    per_group: DataFrame | None = None,
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """Running sum of ``weight`` (default: row number) in each group and the sum of the group.

    An empty ``group`` orders the whole frame. ``per_group`` (one row per group) is joined on the group; when groups
    are cut it is attached to the small table of block totals, so the rows do not move by the group alone.
    Rows without a group are left out.
    """
    keys = list(group)
    kept = df.columns
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    weight = F.lit(1).cast("bigint") if weight is None else weight
    extra = [c for c in per_group.columns if c not in keys] if per_group is not None else []
    up_to_here = (Window.unboundedPreceding, 0)

    df = df.dropna("any", subset=keys)
    cuts = find_cuts(df, keys, order, rows_per_block) if rows_per_block else []
    if not cuts:
        whole = Window.partitionBy(*keys)
        summed = df.withColumns(
            {
                running: F.sum(weight).over(whole.orderBy(*order).rowsBetween(*up_to_here)),
                total: F.sum(weight).over(whole),
            }
        )
        joined = summed if per_group is None else summed.join(per_group, keys)
        return joined.select(*kept, running, total, *extra)

    blocked = with_blocks(df, cuts, keys, order)
    totals = _block_totals(blocked, keys, weight)
    if per_group is not None:
        totals = totals.join(per_group, keys)
    in_block = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(*up_to_here)
    return (
        blocked.withColumn("_local", F.sum(weight).over(in_block))
        .join(totals, [*keys, BLOCK])
        .select(
            *kept,
            (F.col("_before") + F.col("_local")).alias(running),
            F.col("_total").alias(total),
            *extra,
        )
    )
