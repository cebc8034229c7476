"""Time-grid and panel builders.

All builders work on a long measurement table.  Raw rows are reduced to one
row per (entity, feature, bin) with partial (map-side) aggregation *before*
any per-entity window runs, so the rows of one entity that reach a window
task are bounded by its time span / bin width, not by its raw row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.scalar import hour_bin, hours_between, null_count, r6


# --------------------------------------------------------------------------
# origins and bounds
# --------------------------------------------------------------------------

def admission_origin(meas: DataFrame, entity: str, time: str, feature: str,
                     admission_feature: str, name: str = "origin") -> DataFrame:
    """One row per entity: time of its first ``admission_feature`` row."""
    return (meas.filter(F.col(feature) == admission_feature)
            .groupBy(entity).agg(F.min(time).alias(name)))


def first_chart_origin(meas: DataFrame, entity: str, time: str, name: str = "origin") -> DataFrame:
    """One row per entity: time of its first row of any feature."""
    return meas.groupBy(entity).agg(F.min(time).alias(name))


def feature_bounds(meas: DataFrame, feature_ranges: DataFrame, source: str, value: str,
                   sigma: float = 3.0) -> DataFrame:
    """Trimming bounds per feature.

    ``feature_ranges``: ``(source, feature, lo, hi, range_only)`` (a small
    dictionary table, broadcast).  Mean and sample std are taken over the
    values inside ``[lo, hi]`` (all values when no range is known); bounds are
    ``[max(lo, m - k s), min(hi, m + k s)]``; range-only features keep
    ``[lo, hi]``.  Result has one row per dictionary feature.
    """
    ranges = F.broadcast(feature_ranges)
    in_range = F.col("lo").isNull() | F.col(value).between(F.col("lo"), F.col("hi"))
    stats = (meas.select(source, value).join(ranges, source)
             .filter(in_range)
             .groupBy(source).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s")))
    lo_stat = F.col("_m") - F.lit(sigma) * F.col("_s")
    hi_stat = F.col("_m") + F.lit(sigma) * F.col("_s")
    # stats has at most one row per dictionary feature: bounded broadcast
    return (feature_ranges.join(F.broadcast(stats), source, "left")
            .select(source, "feature",
                    F.when(F.col("range_only"), F.col("lo"))
                     .when(F.col("lo").isNull(), lo_stat)
                     .otherwise(F.greatest(F.col("lo"), lo_stat)).alias("lo_b"),
                    F.when(F.col("range_only"), F.col("hi"))
                     .when(F.col("hi").isNull(), hi_stat)
                     .otherwise(F.least(F.col("hi"), hi_stat)).alias("hi_b")))


def trimmed_hourly_median(meas: DataFrame, origin: DataFrame, bounds: DataFrame, entity: str,
                          time: str, source: str, value: str, min_hours: float = -1.0,
                          out: str = "median_value") -> DataFrame:
    """Outlier-trim + hourly median.

    Rows of entities in ``origin`` (inner join = cohort filter), at or after
    ``min_hours`` from the origin and inside the feature bounds, are binned to
    whole hours (truncation toward zero) and reduced with the exact median.
    ``bounds`` has one row per dictionary feature, so it is broadcast.
    """
    delta = hours_between("origin", time)
    return (meas.select(entity, time, source, value)
            .join(origin.select(entity, "origin"), entity)
            .join(F.broadcast(bounds), source)
            .filter((delta >= F.lit(min_hours)) & F.col(value).between(F.col("lo_b"), F.col("hi_b")))
            .withColumn("hour", hour_bin(delta))
            .groupBy(entity, "feature", "hour")
            .agg(r6(F.median(value)).alias(out)))


# --------------------------------------------------------------------------
# class-wise pivot to a wide hourly panel
# --------------------------------------------------------------------------

def classwise_reduce(long_df: DataFrame, keys: list[str], feature: str, value: str,
                     text_value: str | None, order_col: str,
                     classes: list[tuple[str, str, str]]) -> DataFrame:
    """Pivot long -> wide with a reducer per feature class, in ONE aggregation.

    ``classes``: ``(source_item, output_column, reducer)`` with reducer in
    ``numeric`` (median), ``summed`` (sum, all-null -> 0), ``string`` (first
    text value in ``order_col`` order, null kept; of rows at one time the
    smallest text), ``first`` (first numeric).
    Conditional aggregation replaces the per-feature pivots and the N-way
    full outer join fold: one shuffle on ``keys``.
    """
    aggs: list[Column] = []
    for src, out, reducer in classes:
        hit = F.col(feature) == F.lit(src)
        if reducer == "numeric":
            aggs.append(r6(F.median(F.when(hit, F.col(value)))).alias(out))
        elif reducer == "summed":
            aggs.append(r6(F.coalesce(F.sum(F.when(hit, F.col(value))), F.lit(0.0))).alias(out))
        elif reducer == "string":
            # first row of the feature in chart order; its text may be null
            aggs.append(F.min_by(F.when(hit, F.struct(F.col(text_value).alias("v"))),
                                 F.when(hit, F.struct(order_col, text_value)))["v"].alias(out))
        elif reducer == "first":
            aggs.append(F.min_by(F.when(hit, F.struct(F.col(value).alias("v"))),
                                 F.when(hit, F.struct(order_col, value)))["v"].alias(out))
        else:
            raise ValueError(f"unknown reducer {reducer!r}")
    srcs = sorted({c[0] for c in classes})
    return long_df.filter(F.col(feature).isin(*srcs)).groupBy(*keys).agg(*aggs)


def pivot_median(long_df: DataFrame, keys: list[str], feature: str, value: str,
                 features: list[str]) -> DataFrame:
    """``groupBy(keys).pivot(feature, features).median(value)`` with an explicit
    value list (no extra job to discover the pivot values)."""
    p = long_df.groupBy(*keys).pivot(feature, features).agg(F.median(value))
    return p.select(*keys, *[r6(F.col(f)).alias(f) for f in features])


# --------------------------------------------------------------------------
# dense grids and re-origin
# --------------------------------------------------------------------------

def dense_grid(bins: DataFrame, entity: str, t: str, start: int | None = 0) -> DataFrame:
    """All bins ``start..max(t)`` per entity (``start=None``: ``min(t)..max(t)``).

    ``sequence`` counts down when the end is below the start, so entities
    whose last bin is before ``start`` get no grid row.
    """
    lo = F.lit(start) if start is not None else F.min(t)
    g = bins.groupBy(entity).agg(lo.cast("bigint").alias("_lo"), F.max(t).cast("bigint").alias("_hi"))
    g = g.filter(F.col("_hi") >= F.col("_lo"))
    return g.select(entity, F.explode(F.sequence("_lo", "_hi")).alias(t))


def fixed_grid(entities: DataFrame, entity: str, t: str, n_bins: int) -> DataFrame:
    """``entity x 0..n_bins-1`` as a generator (no join)."""
    return entities.select(entity).distinct().select(
        entity, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_bins - 1).cast("bigint"))).alias(t))


def densify(panel: DataFrame, entity: str, t: str, start: int | None = 0) -> DataFrame:
    """Dense grid ``start..max(t)`` per entity with the panel's values on
    observed bins and nulls elsewhere (``start=None``: from the first bin).

    One window over the entity: every row explodes the gap back to the
    previous row (the first row back to ``start``), so no grid table is
    built and nothing is joined back.  Rows before ``start`` are dropped;
    an entity with no bin at or after ``start`` yields no rows."""
    cols = [c for c in panel.columns if c not in (entity, t)]
    p = panel if start is None else panel.filter(F.col(t) >= start)
    prev = F.lag(t).over(Window.partitionBy(entity).orderBy(t))
    first = F.lit(start).cast("bigint") if start is not None else F.col(t).cast("bigint")
    lo = F.when(prev.isNull(), first).otherwise(prev.cast("bigint") + 1)
    x = p.select(entity, F.col(t).cast("bigint").alias("_t"), *cols, lo.alias("_lo"))
    x = x.select(entity, "_t", *cols, F.explode(F.sequence("_lo", "_t")).alias(t))
    return x.select(entity, t, *[F.when(F.col(t) == F.col("_t"), F.col(c)).alias(c) for c in cols])


def reorigin(panel: DataFrame, entity: str, t: str, valid: Column, keep_before: bool = False,
             require_valid: bool = True) -> DataFrame:
    """Shift ``t`` so that the first valid row of each entity is 0.

    ``valid`` is the validity predicate (e.g. any vital present).  Entities
    with no valid row are dropped when ``require_valid``.  Rows before the
    first valid row are dropped unless ``keep_before`` (they get negative t).
    The origin is a window minimum over the entity's (binned) rows.
    """
    out = panel.withColumn("_t0", F.min(F.when(valid, F.col(t))).over(Window.partitionBy(entity)))
    if require_valid:
        out = out.filter(F.col("_t0").isNotNull())
    if not keep_before:
        out = out.filter(F.col(t) >= F.col("_t0"))
    return out.withColumn(t, F.col(t) - F.col("_t0")).drop("_t0")


def trim_trailing(panel: DataFrame, entity: str, t: str, keep: Column) -> DataFrame:
    """Drop rows after the last row where ``keep`` holds; entities without
    any such row are dropped (window maximum over the entity's bins)."""
    last = F.max(F.when(keep, F.col(t))).over(Window.partitionBy(entity))
    return (panel.withColumn("_tl", last)
            .filter(F.col("_tl").isNotNull() & (F.col(t) <= F.col("_tl"))).drop("_tl"))


def add_null_count(panel: DataFrame, cols: list[str], name: str = "total_missing") -> DataFrame:
    return panel.withColumn(name, null_count(cols))
