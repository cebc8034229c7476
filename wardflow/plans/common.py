"""Shared derived tables the registered queries start from (all built from
the driver tables, so their work grows with the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.dictionary import EVENT_FEATURES, numeric_feature_ranges
from wardflow.functions.scalar import minutes_between
from wardflow.operators import panel as P
from wardflow.sources.tables import (ADMISSION_FEATURE, ENTITY, FEATURE, TEXT_VALUE, TIME, VALUE,
                                     measurements, read_table)

# hourly features of the wide panel, in canonical order
HOURLY_FEATURES = [f for _s, f, _c, col in EVENT_FEATURES if col == "value"]
# daily cohort panel: numeric features, one median per (user, day)
DAILY = [("view", "heart_rate"), ("click", "pam_invasive"), ("purchase", "pam_non_invasive"),
         ("error", "fio2")]
DAILY_COLS = [f for _s, f in DAILY]
COHORT_DAYS = 20          # fixed-grid cohort length (bins)
COHORT_MAX_MISSING = 14   # exclusion: more missing bins than this in any variable


def hourly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    meas = measurements(spark, sf_dir)
    origin = P.admission_origin(meas, ENTITY, TIME, FEATURE, ADMISSION_FEATURE)
    bounds = P.feature_bounds(meas, numeric_feature_ranges(spark), FEATURE, VALUE)
    return P.trimmed_hourly_median(meas, origin, bounds, ENTITY, TIME, FEATURE, VALUE)


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, hour, <hourly features>)`` from the trimmed hourly medians."""
    return (hourly_long(spark, sf_dir).groupBy(ENTITY, "hour")
            .pivot("feature", HOURLY_FEATURES).agg(F.max("median_value")))


def daily_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, day, heart_rate, pam_invasive, pam_non_invasive, fio2)``,
    days counted from the user's first chart time; only days with data."""
    meas = measurements(spark, sf_dir)
    t0 = P.first_chart_origin(meas, ENTITY, TIME, "t0")
    binned = (meas.join(t0, ENTITY)
              .withColumn("day", F.floor(minutes_between("t0", TIME) / F.lit(1440.0))))
    return P.classwise_reduce(binned, [ENTITY, "day"], FEATURE, VALUE, None, TIME,
                              [(s, f, "numeric") for s, f in DAILY])


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense daily panel 0..last day per user (empty days = null row)."""
    return P.densify(daily_sparse(spark, sf_dir), ENTITY, "day", 0)


def cohort_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-length cohort: dense daily panel with ``total_missing``, trailing
    days with every variable missing trimmed, users whose last valid day
    reaches ``COHORT_DAYS - 1`` kept on days ``0..COHORT_DAYS-1``, users with
    more than ``COHORT_MAX_MISSING`` missing days in any variable excluded."""
    dp = P.add_null_count(daily_panel(spark, sf_dir), DAILY_COLS)
    trimmed = P.trim_trailing(dp, ENTITY, "day", F.col("total_missing") < len(DAILY_COLS))
    # per-entity windows over the binned panel: they share the entity
    # partitioning of the panel (no join back, no re-computation)
    w = Window.partitionBy(ENTITY)
    cohort = (trimmed.withColumn("max_valid_interval", F.max("day").over(w))
              .filter((F.col("max_valid_interval") > COHORT_DAYS - 1) & (F.col("day") < COHORT_DAYS)))
    worst = F.greatest(*[F.sum(F.col(c).isNull().cast("int")).over(w) for c in DAILY_COLS])
    return cohort.withColumn("_mx", worst).filter(F.col("_mx") <= COHORT_MAX_MISSING).drop("_mx")


def cohort_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort panel unpivoted: ``(user_id, day, feature, original)``."""
    cp = cohort_panel(spark, sf_dir)
    return cp.unpivot([ENTITY, "day"], DAILY_COLS, "feature", "original")


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stay table from ``orders``: ``(o_custkey, o_orderkey, in_time,
    out_time, o_orderpriority, o_totalprice, o_orderstatus)``.
    Out time = in time + (1 + orderkey mod 7) days; open ('O') stays have
    no out time."""
    o = read_table(spark, sf_dir, "orders")
    out = F.when(F.col("o_orderstatus") != "O",
                 F.col("o_orderdate") + F.make_dt_interval(
                     (F.lit(1) + F.pmod("o_orderkey", F.lit(7))).cast("int")))
    return o.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("in_time"),
                    out.alias("out_time"), "o_orderpriority", "o_totalprice", "o_orderstatus")


STAYS_CTE = """stays AS (SELECT o_custkey, o_orderkey, o_orderdate AS in_time,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 7 AS INTEGER)) END AS out_time,
  o_orderpriority, o_totalprice, o_orderstatus FROM orders)"""
