"""Latency summaries with exact nearest-rank percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.plans.joins import BROADCAST_BYTES, attach
from termloom.plans.staging import stage

# The sketch is off by at most 1/ACCURACY of a group's rows; MARGIN leaves ten times that.
ACCURACY = 20_000
MARGIN = 10 / ACCURACY


def latency_summary(
    samples: DataFrame,
    percentiles: tuple[int, ...] = (50, 95),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``term, n, p50, p95, min, max`` of ``samples(term, dur_ms)``.

    A percentile is the value at rank ``ceil(p/100 * n)``. A sketch, merged from the tasks,
    brackets it; values below the bracket are only counted, and ranks are taken among the few
    distinct values inside it. So the result is exact and no group is sorted whole. Null and NaN
    samples do not count.
    """
    measured = F.col("dur_ms").isNotNull() & ~F.isnan(F.col("dur_ms").cast("double"))
    samples = samples.filter(measured).select("term", "dur_ms")
    # Null is a group of its own and must survive the joins below.
    samples = samples.withColumn(
        "_key", F.coalesce(F.concat(F.lit("="), F.col("term").cast("string")), F.lit(""))
    )
    bounds = [b for p in percentiles for b in (p / 100 - MARGIN, p / 100 + MARGIN)]
    grid = F.percentile_approx(
        "dur_ms", [min(max(b, 0.0), 1.0) for b in bounds], ACCURACY
    )
    # One row per term, written so that the sketch is built by one pass and not by each use.
    groups = stage(
        samples.groupBy("_key", "term").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("dur_ms").alias("min"),
            F.max("dur_ms").alias("max"),
            grid.alias("_grid"),
        ),
        "latency-groups",
    )

    def bracket(i: int, p: int):
        low, high = bounds[2 * i], bounds[2 * i + 1]
        rank = F.least(F.greatest(F.ceil(F.lit(p / 100) * F.col("n")), F.lit(1)), F.col("n"))
        return F.struct(
            F.lit(p).alias("p"),
            rank.alias("rank"),
            (F.get("_grid", F.lit(2 * i)) if low > 0 else F.col("min")).alias("low"),
            (F.get("_grid", F.lit(2 * i + 1)) if high < 1 else F.col("max")).alias("high"),
        )

    brackets = groups.select(
        "_key", F.inline(F.array(*[bracket(i, p) for i, p in enumerate(percentiles)]))
    )
    values = samples.groupBy("_key", "dur_ms").agg(F.count(F.lit(1)).alias("n"))
    # All values below a bracket fold into one row with a null value, which sorts first.
    inside = (
        attach(values, brackets, "_key", broadcast_bytes=broadcast_bytes)
        .filter(F.col("dur_ms") <= F.col("high"))
        .groupBy(
            "_key", "p", "rank", F.when(F.col("dur_ms") >= F.col("low"), F.col("dur_ms")).alias("v")
        )
        .agg(F.sum("n").alias("n"))
    )
    running = F.sum("n").over(Window.partitionBy("_key", "p").orderBy(F.asc_nulls_first("v")))
    reached = (
        inside.withColumn("_seen", running)
        .filter(F.col("_seen") >= F.col("rank"))
        .groupBy("_key")
        .agg(
            *[
                F.min_by(
                    F.struct("v"), F.when(F.col("p") == p, F.col("_seen"))
                )["v"].alias(f"_p{p}")
                for p in percentiles
            ]
        )
    )
    # The sketch's bound makes a miss impossible; should it ever happen, fail, don't guess.
    missed = F.raise_error(F.lit("percentile bracket missed"))
    exact = [F.coalesce(F.col(f"_p{p}"), missed).alias(f"p{p}") for p in percentiles]
    return groups.join(reached, "_key", "left").select("term", "n", *exact, "min", "max")
