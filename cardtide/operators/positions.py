"""The place of each row in a declared order, as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.stages import Stages

#: Rows of one partition that ids leave room for.
_WITHIN = (1 << 33) - 1


def positioned(df: DataFrame, order: list[Column], stages: Stages, out: str = "position") -> DataFrame:
    """``df`` with the position of each row, from 1, in ``order``.

    Rows are dealt out by range and sorted inside each part; a part's rows are then numbered on their
    own and moved on by the number of rows in the parts before it. Only one number per part meets in
    one task. The sorted parts are a stage, so that both steps see the same ranges. Rows equal in all
    of ``order`` take consecutive places in any order.
    """
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = stages.keep(numbered, "sorted")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row per partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(starts), part == F.col("_part"))
    return placed.select(*df.columns, (F.col("_before") + F.col("_at").bitwiseAND(_WITHIN) + 1).alias(out))
