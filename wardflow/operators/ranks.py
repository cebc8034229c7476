"""Row numbers and running sums along a global order.

Rows are range-partitioned on the order with bounds that Spark samples from
the data, sorted there and written as a table, so that each row keeps its
partition and its place in it.  Counts per partition, summed over the
partitions before it, turn the place into a row number: no window runs over
more than the list of partitions.  A last sort key made from the input's row
places splits ties, so neither one outlier nor a value that most rows share
makes a range larger than the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.sources.io import write_scratch

#: ``monotonically_increasing_id`` holds the partition above this many bits
PLACE_BITS = 33


def sorted_ranges(df: DataFrame, order: list[Column], part: str = "_part", place: str = "_place") -> DataFrame:
    """``df`` sorted by ``order``, as a table with two more columns: the range
    that a row is in (ascending along the order) and its place there, from 0.
    Rows equal in ``order`` keep no defined order among themselves but may
    lie in several ranges."""
    at = F.col("_at")
    d = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*order, F.col("_tie").asc()]
    d = d.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    d = write_scratch(d.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    return d.withColumns({part: F.shiftright(at, PLACE_BITS), place: at.bitwiseAND((1 << PLACE_BITS) - 1)}).drop("_at")


def number_rows(df: DataFrame, order: list[Column], group: list[str] | None = None, name: str = "number",
                size: str | None = None) -> DataFrame:
    """``df`` with 0-based numbers along ``order`` within each group (nulls
    are a group), and with the group's size if ``size`` names a column."""
    group = group or []
    d = sorted_ranges(df, [*[F.col(g).asc_nulls_first() for g in group], *order])
    here = d.groupBy("_part", *group).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    here = here.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_size": F.sum("_n").over(whole)})
    here = here.select(*[F.col(c).alias(f"_h_{c}") for c in ["_part", *group]], "_first", "_before", "_size")
    same = F.col("_part") == F.col("_h__part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_h_{g}"))
    out = d.join(here, same).withColumn(name, F.col("_before") + F.col("_place") - F.col("_first"))
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.select(*df.columns, name, *([size] if size else []))


def running(df: DataFrame, order: list[Column], values: dict[str, tuple[str, str]], group: list[str] | None = None) -> DataFrame:
    """``df`` with running aggregates along ``order`` (total within each
    group), the row itself included: ``values`` maps a new column to ``(how,
    column)``, ``how`` one of ``sum, max, min``, ``last`` (the last value that
    is not null) or ``lag`` (the value of the row before).  Aggregates per range, those of the ranges before put
    together over the list of ranges, and a window within each range."""
    group = group or []
    d = sorted_ranges(df, [*[F.col(g).asc_nulls_first() for g in group], *order])
    total = {"sum": lambda v: F.sum(v), "max": lambda v: F.max(v), "min": lambda v: F.min(v),
             "last": lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_place"))),
             "lag": lambda v: F.struct(F.max_by(v, "_place").alias("v"))}
    over = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda v: F.last(v, ignorenulls=True), "lag": lambda v: F.last(v)}
    both = {"sum": lambda b, v: F.coalesce(b + v, v, b), "max": F.greatest, "min": F.least, "last": lambda b, v: F.coalesce(v, b),
            "lag": lambda b, v: F.when(v["there"], v["v"]).otherwise(b["v"])}
    here = d.groupBy("_part", *group).agg(*[total[how](c).alias(f"_all_{name}") for name, (how, c) in values.items()])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    here = here.select(*[F.col(c).alias(f"_h_{c}") for c in ["_part", *group]],
                       *[over[how](f"_all_{name}").over(before).alias(f"_before_{name}") for name, (how, _c) in values.items()])
    same = F.col("_part") == F.col("_h__part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_h_{g}"))
    along = Window.partitionBy("_part", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    lag = Window.partitionBy("_part", *group).orderBy("_place")
    local = d.withColumns({f"_local_{name}": F.struct(F.lag(c).over(lag).alias("v"), F.lag(F.lit(True), 1, False).over(lag).alias("there"))
                           if how == "lag" else over[how](c).over(along) for name, (how, c) in values.items()})
    return local.join(here, same).select(*df.columns, *[both[how](F.col(f"_before_{name}"), F.col(f"_local_{name}")).alias(name)
                                                        for name, (how, _c) in values.items()])


def running_sums(df: DataFrame, order: list[Column], values: list[str], group: list[str] | None = None, prefix: str = "cum_") -> DataFrame:
    """:func:`running` sums of ``values``, named with ``prefix``."""
    return running(df, order, {f"{prefix}{v}": ("sum", v) for v in values}, group)
