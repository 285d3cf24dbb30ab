"""Row numbers and limits that do not pass a whole group through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.plans.joins import attach
from termloom.plans.staging import stage

# Up to this limit Spark keeps the first rows per group before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold), and one task may merge the tasks' first rows.
GROUP_LIMIT = 1000
# Ids per block when a limit is cut by block counts.
CUT_BLOCK = 1_000_000

_POSITION_BITS = 33


def with_dense_ids(
    df: DataFrame, after: int = 0, order_by: list[Column] | None = None, id_column: str = "id"
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, …`` in parallel.

    The rows are written once with their task and position, which fixes both; the start of each
    task is the running total of the task sizes, one row per task.
    """
    if order_by:
        df = df.orderBy(*order_by)
    at = F.col("_at")
    rows = stage(df.withColumn("_at", F.monotonically_increasing_id()), "dense-ids").select(
        *df.columns,
        F.shiftright(at, _POSITION_BITS).alias("_task"),
        at.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    sizes = rows.groupBy("_task").agg((F.max("_position") + 1).alias("_size"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    numbered = attach(rows, starts, "_task")
    return numbered.select(
        (F.lit(after) + F.col("_start") + F.col("_position") + 1).cast("long").alias(id_column),
        *df.columns,
    )


def first_by_id(rows: DataFrame, limit: int, id_column: str = "doc_id") -> DataFrame:
    """The ``limit`` rows with the smallest ids, ordered by id."""
    if limit <= GROUP_LIMIT:
        return rows.orderBy(id_column).limit(limit)
    grouped = rows.withColumn("_group", F.lit(0)).withColumn("_limit", F.lit(limit).cast("long"))
    return _cut(grouped, "_group", id_column).select(*rows.columns).orderBy(id_column)


def newest(rows: DataFrame, limit: int, time: str, id_column: str) -> DataFrame:
    """The ``limit`` rows with the latest ``time``, ties by the higher id; rows without one come last.

    A large limit is cut by counts per hour: later hours are kept whole, and only the hour in
    which the limit falls is numbered, over range partitions.
    """
    order = [F.desc(time), F.desc(id_column)]
    if limit <= GROUP_LIMIT:
        return rows.orderBy(*order).limit(limit)
    hour = F.date_trunc("hour", F.col(time))
    counts = rows.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    # One row per hour.
    running = F.sum("n").over(Window.orderBy(F.desc("hour"))) - F.col("n")
    begun = counts.withColumn("before", running).filter(F.col("before") < limit)
    last = begun.orderBy(F.desc("before")).first()
    if last is None:
        return rows.limit(0)
    in_last = hour.isNull() if last["hour"] is None else hour == last["hour"]
    later = hour.isNotNull() if last["hour"] is None else hour > last["hour"]
    ranked = with_dense_ids(rows.filter(in_last), order_by=order, id_column="_rank")
    cut = ranked.filter(F.col("_rank") <= limit - last["before"]).drop("_rank")
    return rows.filter(later).unionByName(cut).orderBy(*order)


def first_per_group(
    rows: DataFrame, group: str, limit: str, largest_limit: int, id_column: str = "doc_id"
) -> DataFrame:
    """The rows with the smallest ids of each group, as many as its ``limit`` column says.

    ``largest_limit`` bounds the column. Small limits are cut before the shuffle; beyond that
    the cut is found from counts per id block.
    """
    if largest_limit <= GROUP_LIMIT:
        order = Window.partitionBy(group).orderBy(id_column)
        ranked = rows.withColumn("_rank", F.row_number().over(order))
        # The literal bound lets Spark prune inside each task; the column bound finishes.
        kept = ranked.filter(F.col("_rank") <= largest_limit).filter(
            F.col("_rank") <= F.col(limit)
        )
        return kept.drop("_rank")
    return _cut(rows.withColumn("_limit", F.col(limit)), group, id_column)


def _cut(rows: DataFrame, group: str, id_column: str) -> DataFrame:
    """Keep ``_limit`` rows per group by id without ranking more than one block of a group.

    Ids are unique within a group, so a block holds at most ``CUT_BLOCK`` rows. Blocks before
    the one in which the limit falls are kept whole; only that one is ranked.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(id_column) / CUT_BLOCK))
    counts = blocked.groupBy(group, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_limit").alias("_l")
    )
    running = Window.partitionBy(group).orderBy("_block")
    before = F.sum("_n").over(running) - F.col("_n")
    wanted = counts.select(
        group, "_block", "_n", F.greatest(F.col("_l") - before, F.lit(0)).alias("_room")
    ).filter(F.col("_room") > 0)
    in_block = blocked.drop("_limit").join(wanted, [group, "_block"])
    whole = in_block.filter(F.col("_room") >= F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(group, "_block").orderBy(id_column))
    partial = (
        in_block.filter(F.col("_room") < F.col("_n"))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= F.col("_room"))
    )
    columns = [c for c in rows.columns if c != "_limit"]
    return whole.select(*columns).unionByName(partial.select(*columns))
