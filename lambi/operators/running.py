"""Numbers and sums along an order, without one task or the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lambi.sources.shared import kept


def running(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), value: str | None = None, keep: Callable[[DataFrame], DataFrame] = kept) -> DataFrame:
    """Adds `number`, the 0-based place of each row among its group's in the given order, and `size`,
    the rows of the group; with `value` also `before`, the group's sum of it in the rows before (null
    counts as 0).

    Rows are dealt by ranges of (group, order), sorted there and kept; what comes before a range
    follows from one row for each range and group. So a group of any size is spread over tasks; rows
    equal in the whole order should be equal altogether, else their numbers may change places. The
    order's nulls come first; a null in `group` is a group. An empty table stays empty.
    """
    keys = [*group, *order]
    placed = keep(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    add = {} if value is None else {"_sum": F.coalesce(F.sum(value), F.lit(0))}
    runs = placed.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"), *(e.alias(c) for c, e in add.items()))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("size", F.sum("_n").over(whole)).withColumn("_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if value is not None:
        runs = runs.withColumn("_sum", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    names = {c: f"_run_{c}" for c in ("_part", *group)}
    on = [F.col(c).eqNullSafe(F.col(r)) for c, r in names.items()]
    out = placed.join(runs.withColumnsRenamed(names), on).drop(*names.values())
    if value is not None:
        inside = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("before", F.col("_sum") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_sum")
    return out.withColumn("number", F.col("_at") - F.col("_first") + F.col("_n")).drop("_at", "_part", "_first", "_n")
