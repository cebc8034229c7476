"""Panel queries over the measurement table (``events``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.dictionary import EVENT_FEATURES
from wardflow.functions.scalar import any_not_null, hour_bin, hours_between
from wardflow.operators import panel as P
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.plans.sql_common import cohort_ctes, daily_panel_ctes, hourly_ctes, hourly_wide_cte
from wardflow.sources.tables import ENTITY, FEATURE, TEXT_VALUE, TIME, VALUE, measurements

HF = C.HOURLY_FEATURES
HF_SQL = ", ".join(HF)


@query("hourly_median", sql=f"WITH {hourly_ctes()}\nSELECT * FROM hm")
def hourly_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort join on admission, per-feature range + 3 sigma
    trimming, hour bins from admission (>= -1 h), exact hourly median."""
    return C.hourly_long(spark, sf_dir)


_CLASS_SQL = ",\n  ".join(
    (f"round(median(CASE WHEN event_type = '{s}' THEN value END), 6) AS {f}" if c == "numeric" else
     f"round(coalesce(sum(CASE WHEN event_type = '{s}' THEN value END), 0), 6) AS {f}" if c == "summed" else
     f"arg_min_null({col}, ts) FILTER (WHERE event_type = '{s}') AS {f}")
    for s, f, c, col in EVENT_FEATURES)
_CLASS_SRCS = ", ".join(sorted({f"'{s}'" for s, *_ in EVENT_FEATURES}))


@query("hourly_panel_classwise", sql=f"""
WITH t0 AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
b AS (SELECT e.*, CAST(trunc(date_sub('minute', t0.t0, e.ts) / 60.0) AS BIGINT) AS hour
      FROM events e JOIN t0 ON e.user_id = t0.user_id)
SELECT user_id, hour,
  {_CLASS_SQL}
FROM b WHERE event_type IN ({_CLASS_SRCS}) GROUP BY user_id, hour""")
def hourly_panel_classwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour bins from the first chart time, one aggregation with a
    reducer per feature class (median / sum with all-null = 0 / first text in
    chart order) instead of per-feature pivots joined together."""
    meas = measurements(spark, sf_dir)
    t0 = P.first_chart_origin(meas, ENTITY, TIME, "t0")
    binned = meas.join(t0, ENTITY).withColumn("hour", hour_bin(hours_between("t0", TIME)))
    classes = [(s, f, c) for s, f, c, _col in EVENT_FEATURES]
    return P.classwise_reduce(binned, [ENTITY, "hour"], FEATURE, VALUE, TEXT_VALUE, TIME, classes)


def _fold_sql() -> str:
    parts = [f"f{i} AS (SELECT user_id, hour, median_value AS {f} FROM hm WHERE feature = '{f}')"
             for i, f in enumerate(HF)]
    joins = " ".join(f"FULL JOIN f{i} USING (user_id, hour)" for i in range(1, len(HF)))
    return (f"WITH {hourly_ctes()},\n" + ",\n".join(parts) +
            f"\nSELECT user_id, hour, {HF_SQL} FROM f0 {joins}")


@query("pivot_full_join_equiv", sql=_fold_sql())
def pivot_full_join_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The N-way full outer join of per-feature series, computed as one
    pivot (explicit value list) on the long table; the oracle is the fold."""
    return C.hourly_wide(spark, sf_dir).select(ENTITY, "hour", *HF)


@query("pressure_merge", sql=f"""
WITH {hourly_ctes()},
inv AS (SELECT user_id, hour, median_value AS v FROM hm WHERE feature = 'pam_invasive'),
non AS (SELECT user_id, hour, median_value AS v FROM hm WHERE feature = 'pam_non_invasive')
SELECT user_id, hour, coalesce(inv.v, non.v) AS pam FROM inv FULL JOIN non USING (user_id, hour)""")
def pressure_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invasive value first, non-invasive otherwise, over the union
    of both series' (entity, hour) keys -- one conditional aggregation
    (same result as the keyed full outer join, without a second shuffle)."""
    hm = C.hourly_long(spark, sf_dir).filter(F.col("feature").isin("pam_invasive", "pam_non_invasive"))
    merged = hm.groupBy(ENTITY, "hour").agg(
        F.max(F.when(F.col("feature") == "pam_invasive", F.col("median_value"))).alias("_inv"),
        F.max(F.when(F.col("feature") == "pam_non_invasive", F.col("median_value"))).alias("_non"))
    return merged.select(ENTITY, "hour", F.coalesce("_inv", "_non").alias("pam"))


@query("dense_grid", sql=f"""
WITH {hourly_ctes()},
hr AS (SELECT user_id, hour, median_value AS heart_rate FROM hm WHERE feature = 'heart_rate'),
g AS (SELECT user_id, UNNEST(generate_series(0, mx)) AS hour
      FROM (SELECT user_id, max(hour) AS mx FROM hr GROUP BY user_id) WHERE mx >= 0)
SELECT g.user_id, g.hour, hr.heart_rate FROM g LEFT JOIN hr ON g.user_id = hr.user_id AND g.hour = hr.hour""")
def dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour 0..last per entity, observed hours joined on."""
    hr = (C.hourly_long(spark, sf_dir).filter(F.col("feature") == "heart_rate")
          .select(ENTITY, "hour", F.col("median_value").alias("heart_rate")))
    return P.densify(hr, ENTITY, "hour", 0)


@query("fixed_grid", sql=f"""
WITH {hourly_ctes()},
{hourly_wide_cte()},
g AS (SELECT u.user_id, h.hour FROM (SELECT DISTINCT user_id FROM hm) u CROSS JOIN range(0, 168) h(hour))
SELECT g.user_id, g.hour, {", ".join("hw." + f for f in HF)}
FROM g LEFT JOIN hw ON g.user_id = hw.user_id AND g.hour = hw.hour""")
def fixed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2/C8 (T6 is ``week_panel``): one-week grid (hours 0..167) for every entity with data,
    wide features left-joined.  The grid is an ``explode(sequence)``
    generator, not a cross join."""
    wide = C.hourly_wide(spark, sf_dir)
    grid = P.fixed_grid(C.hourly_long(spark, sf_dir), ENTITY, "hour", 168)
    return grid.join(wide, [ENTITY, "hour"], "left").select(ENTITY, "hour", *HF)


@query("reorigin_any", sql=f"""
WITH {hourly_ctes()},
{hourly_wide_cte()},
g AS (SELECT user_id, UNNEST(generate_series(0, mx)) AS hour
      FROM (SELECT user_id, max(hour) AS mx FROM hw GROUP BY user_id) WHERE mx >= 0),
d AS (SELECT g.user_id, g.hour, {", ".join("hw." + f for f in HF)}
      FROM g LEFT JOIN hw ON g.user_id = hw.user_id AND g.hour = hw.hour),
o AS (SELECT user_id, min(CASE WHEN {" OR ".join(f + " IS NOT NULL" for f in HF)} THEN hour END) AS t0
      FROM d GROUP BY user_id)
SELECT d.user_id, d.hour - o.t0 AS hour, {", ".join("d." + f for f in HF)}
FROM d JOIN o ON d.user_id = o.user_id WHERE o.t0 IS NOT NULL AND d.hour >= o.t0""")
def reorigin_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense hourly grid re-origined at the first hour with any value
    (leading empty hours dropped, entities without data dropped).  An hour
    that the grid adds has no value, so the origin is found among the observed
    hours, and no window holds the grid."""
    observed = C.hourly_wide(spark, sf_dir).filter(F.col("hour") >= 0)
    return P.densify(P.reorigin(observed, ENTITY, "hour", any_not_null(HF)), ENTITY, "hour", 0).select(ENTITY, "hour", *HF)


@query("reorigin_vital", sql=f"""
WITH {daily_panel_ctes()},
o AS (SELECT user_id, min(CASE WHEN heart_rate IS NOT NULL OR pam_invasive IS NOT NULL THEN day END) AS t0
      FROM dp GROUP BY user_id)
SELECT dp.user_id, dp.day - o.t0 AS day, heart_rate, pam_invasive, pam_non_invasive, fio2
FROM dp JOIN o ON dp.user_id = o.user_id WHERE o.t0 IS NOT NULL""")
def reorigin_vital(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-origin at the first day with a valid vital; earlier days
    kept with negative offsets; entities without a valid vital dropped."""
    dp = C.daily_panel(spark, sf_dir)
    valid = F.col("heart_rate").isNotNull() | F.col("pam_invasive").isNotNull()
    return P.reorigin(dp, ENTITY, "day", valid, keep_before=True).select(ENTITY, "day", *C.DAILY_COLS)


@query("trim_and_cohort", sql=f"""
WITH {cohort_ctes()}
SELECT user_id, day, heart_rate, pam_invasive, pam_non_invasive, fio2, total_missing, max_valid_interval
FROM cp""")
def trim_and_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null count per row, trailing all-missing bins trimmed,
    fixed-length cohort, sparse entities excluded."""
    return C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *C.DAILY_COLS, "total_missing",
                                                "max_valid_interval")
