"""Per-entity sequence queries (fills, interpolation, runs, windows, rate,
leave-one-out residuals) on the daily panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.scalar import exp_score, normal_sf, r6
from wardflow.operators import sequence as S
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.plans.sql_common import cohort_ctes, daily_panel_ctes
from wardflow.sources.tables import ENTITY

D = C.DAILY_COLS
W_ASC = "PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
W_FWD = "PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def _round_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


@query("ffill_bfill", sql=f"""
WITH {daily_panel_ctes()},
f AS (SELECT user_id, day, {", ".join(f"last_value({c} IGNORE NULLS) OVER ({W_ASC}) AS {c}" for c in D)} FROM dp)
SELECT user_id, day, {", ".join(f"coalesce({c}, first_value({c} IGNORE NULLS) OVER ({W_FWD})) AS {c}" for c in D)}
FROM f""")
def ffill_bfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward fill then backward fill per entity and column."""
    return S.ffill_bfill(C.daily_panel(spark, sf_dir), ENTITY, "day", D)


def _interp_sql(edges: str) -> str:
    nb = ",\n  ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) OVER ({W_ASC}) AS {c}_pi, "
        f"last_value({c} IGNORE NULLS) OVER ({W_ASC}) AS {c}_pv, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) OVER ({W_FWD}) AS {c}_ni, "
        f"first_value({c} IGNORE NULLS) OVER ({W_FWD}) AS {c}_nv" for c in D)

    def filled(c):
        inner = f"{c}_pv + ({c}_nv - {c}_pv) * (CAST(i - {c}_pi AS DOUBLE) / ({c}_ni - {c}_pi))"
        if edges == "both":
            inner = f"coalesce({inner}, {c}_pv, {c}_nv)"
        elif edges == "forward":
            inner = f"coalesce({inner}, {c}_pv)"
        return f"round(CASE WHEN {c} IS NOT NULL THEN {c} ELSE {inner} END, 6) AS {c}"

    return f"""WITH {daily_panel_ctes()},
x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM dp),
y AS (SELECT *,
  {nb}
  FROM x)
SELECT user_id, day, {", ".join(filled(c) for c in D)} FROM y"""


def _interp(spark, sf_dir, edges):
    out = S.interpolate(C.daily_panel(spark, sf_dir), ENTITY, "day", D, edges)
    return _round_cols(out, D)


@query("interp_both", sql=_interp_sql("both"))
def interp_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear interpolation by position, edges held."""
    return _interp(spark, sf_dir, "both")


@query("interp_inside", sql=_interp_sql("inside"))
def interp_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear interpolation inside observed rows only."""
    return _interp(spark, sf_dir, "inside")


@query("interp_forward", sql=_interp_sql("forward"))
def interp_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear interpolation, trailing gap held, leading gap null."""
    return _interp(spark, sf_dir, "forward")


@query("volume_rate", sql=f"""
WITH {daily_panel_ctes()},
x AS (SELECT user_id, day, pam_non_invasive AS volume,
             (pam_non_invasive IS NOT NULL AND pam_non_invasive <> 0) AS rd FROM dp),
y AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS tf,
        first_value(CASE WHEN rd THEN day END IGNORE NULLS) OVER ({W_FWD}) AS nt,
        first_value(CASE WHEN rd THEN volume END IGNORE NULLS) OVER ({W_FWD}) AS nv,
        last_value(CASE WHEN rd THEN day END IGNORE NULLS)
          OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt
      FROM x),
z AS (SELECT *, CASE WHEN nt IS NULL THEN NULL WHEN pt IS NOT NULL THEN nv / (nt - pt)
                     WHEN nt = tf THEN nv ELSE nv / (nt - tf) END AS r FROM y)
SELECT user_id, day, volume, round(coalesce(r, last_value(r IGNORE NULLS) OVER ({W_ASC})), 6) AS rate FROM z""")
def volume_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative volume spread back over the bins since the previous
    reading (purchase series as the volume)."""
    dp = C.daily_panel(spark, sf_dir).select(ENTITY, "day", F.col("pam_non_invasive").alias("volume"))
    return _round_cols(S.volume_rate(dp, ENTITY, "day", "volume", "rate"), ["rate"])


# erf polynomial written as SQL text with the same constants as the Spark one
def _sql_erf(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.3275911 * abs({x})))"
    poly = (f"{t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * "
            f"(-1.453152027 + {t} * 1.061405429))))")
    y = f"(1.0 - {poly} * exp(-abs({x}) * abs({x})))"
    return f"(CASE WHEN {x} < 0 THEN -{y} ELSE {y} END)"


def _sql_normal_sf(z: str) -> str:
    return f"(0.5 * (1.0 - {_sql_erf(f'({z}) / sqrt(2.0)')}))"


@query("loo_residual", sql=f"""
WITH {daily_panel_ctes()},
l AS (UNPIVOT dp ON {", ".join(D)} INTO NAME feature VALUE v),
g AS (SELECT d.user_id, d.day, f.feature, l.v
      FROM dp d CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in D)}) f(feature)
      LEFT JOIN l ON l.user_id = d.user_id AND l.day = d.day AND l.feature = f.feature),
x AS (SELECT *, row_number() OVER (PARTITION BY user_id, feature ORDER BY day) AS i FROM g),
y AS (SELECT *,
  last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id, feature ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pi,
  last_value(v IGNORE NULLS) OVER (PARTITION BY user_id, feature ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv,
  first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id, feature ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ni,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id, feature ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nv
  FROM x),
e AS (SELECT user_id, day, feature, v AS value,
        coalesce(pv + (nv - pv) * (CAST(i - pi AS DOUBLE) / (ni - pi)), pv, nv) AS estimate
      FROM y WHERE v IS NOT NULL),
e2 AS (SELECT *, value - estimate AS error FROM e WHERE estimate IS NOT NULL),
st AS (SELECT feature, avg(error) AS m, stddev_pop(error) AS s FROM e2 GROUP BY feature),
z AS (SELECT e2.*, (error - m) / s AS z FROM e2 JOIN st ON e2.feature = st.feature)
SELECT user_id, day, feature, value, round(estimate, 6) AS estimate, round(error, 6) AS error,
       round(z, 6) AS z, round({_sql_normal_sf("abs(z)")}, 6) AS p_tail,
       round(1.0 - exp(-0.2 * z * z), 6) AS exp_score
FROM z""")
def loo_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observed cell re-estimated by leave-one-out linear
    interpolation; residual z-scored per feature (population std) and turned
    into a normal tail probability and an exponential score."""
    long = C.daily_panel(spark, sf_dir).unpivot([ENTITY, "day"], D, "feature", "value")
    est = S.loo_estimate(long, [ENTITY, "feature"], "day", "value", "estimate")
    e = (est.filter(F.col("value").isNotNull() & F.col("estimate").isNotNull())
         .withColumn("error", F.col("value") - F.col("estimate")))
    stats = e.groupBy("feature").agg(F.avg("error").alias("_m"), F.stddev_pop("error").alias("_s"))
    z = (F.col("error") - F.col("_m")) / F.col("_s")
    out = e.join(F.broadcast(stats), "feature").withColumn("z", z)
    return out.select(ENTITY, "day", "feature", "value", r6("estimate").alias("estimate"),
                      r6("error").alias("error"), r6("z").alias("z"),
                      r6(normal_sf(F.abs(F.col("z")))).alias("p_tail"),
                      r6(exp_score("z")).alias("exp_score"))


# --------------------------------------------------------------------------
# gaps and islands
# --------------------------------------------------------------------------

def _runs_by_n(spark, sf_dir, exact: bool) -> DataFrame:
    cp = C.cohort_panel(spark, sf_dir)
    x = cp.select(ENTITY, "day", "total_missing",
                  F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(len(D)).cast("bigint"))).alias("n"))
    flag = (F.col("total_missing") == F.col("n")) if exact else (F.col("total_missing") >= F.col("n"))
    runs = S.run_lengths(x, [ENTITY, "n"], "day", flag)
    return runs.filter(F.col("flag"))


_RUNS_SQL = f"""WITH {cohort_ctes()},
x AS (SELECT cp.user_id, cp.day, cp.total_missing, r.n FROM cp CROSS JOIN range(0, {len(D) + 1}) r(n)),
y AS (SELECT user_id, n, day, (total_missing {{op}} n) AS f,
        row_number() OVER (PARTITION BY user_id, n ORDER BY day)
        - row_number() OVER (PARTITION BY user_id, n, (total_missing {{op}} n) ORDER BY day) AS run FROM x),
runs AS (SELECT user_id, n, f, run, count(*) AS length FROM y GROUP BY user_id, n, f, run)"""


@query("missing_runs", sql=_RUNS_SQL.format(op=">=") +
       "\nSELECT n, length, count(*) AS n_runs FROM runs WHERE f GROUP BY n, length")
def missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-length distribution of bins with at least n missing
    variables, n = 0..4 (gaps-and-islands by row-number difference)."""
    return _runs_by_n(spark, sf_dir, False).groupBy("n", "length").agg(F.count(F.lit(1)).alias("n_runs"))


@query("run_stays", sql=_RUNS_SQL.format(op=">=") +
       "\nSELECT n, length, count(DISTINCT user_id) AS n_stays FROM runs WHERE f GROUP BY n, length")
def run_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: entities touched per (n, run length)."""
    return (_runs_by_n(spark, sf_dir, False).groupBy("n", "length")
            .agg(F.countDistinct(ENTITY).alias("n_stays")))


@query("run_exact", sql=_RUNS_SQL.format(op="=") +
       "\nSELECT n, length, count(*) AS n_runs FROM runs WHERE f GROUP BY n, length")
def run_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of bins with exactly n missing variables."""
    return _runs_by_n(spark, sf_dir, True).groupBy("n", "length").agg(F.count(F.lit(1)).alias("n_runs"))


def _pos_sql() -> str:
    cols = []
    for c in D:
        cols.append(f"""CAST(sum(CAST({c} IS NULL AS INTEGER)) OVER (PARTITION BY user_id, {c} IS NULL, {c}_run
                ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS pos_{c}""")
    runs = ",\n  ".join(f"""row_number() OVER (PARTITION BY user_id ORDER BY day)
     - row_number() OVER (PARTITION BY user_id, {c} IS NULL ORDER BY day) AS {c}_run""" for c in D)
    return f"""WITH {cohort_ctes()},
r AS (SELECT *, {runs} FROM cp)
SELECT user_id, day, {", ".join(cols)} FROM r"""


@query("run_position", sql=_pos_sql())
def run_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each bin inside its run of missing values (0 when
    observed), per variable."""
    df = C.cohort_panel(spark, sf_dir)
    for c in D:
        df = S.position_in_run(df, ENTITY, "day", c, f"pos_{c}")
    return df.select(ENTITY, "day", *[F.col(f"pos_{c}").cast("bigint").alias(f"pos_{c}") for c in D])


MAX_WINDOW = 48


@query("complete_windows", sql=f"""
WITH {daily_panel_ctes()},
y AS (SELECT user_id, day, heart_rate IS NOT NULL AS f,
        row_number() OVER (PARTITION BY user_id ORDER BY day)
        - row_number() OVER (PARTITION BY user_id, heart_rate IS NOT NULL ORDER BY day) AS run FROM dp),
runs AS (SELECT user_id, run, count(*) AS length FROM y WHERE f GROUP BY user_id, run)
SELECT n, CAST(coalesce(sum(greatest(length - n + 1, 0)), 0) AS BIGINT) AS n_windows
FROM range(1, {MAX_WINDOW + 1}) r(n) LEFT JOIN runs ON TRUE GROUP BY n""")
def complete_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of full windows of n consecutive observed bins, n = 1..48:
    a run of L bins holds L - n + 1 of them.  Runs are first counted by length,
    capped at 48 with the excess kept as a sum, so at most 48 rows are left
    for the closed form, whatever the data."""
    runs = S.run_lengths(C.daily_panel(spark, sf_dir), ENTITY, "day",
                         F.col("heart_rate").isNotNull()).filter(F.col("flag"))
    by_length = runs.groupBy(F.least("length", F.lit(MAX_WINDOW)).alias("at_least")).agg(F.count(F.lit(1)).alias("runs"), F.sum("length").alias("bins"))
    h = by_length.agg(F.collect_list(F.struct("at_least", "runs", "bins")).alias("h"))
    n = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(MAX_WINDOW).cast("bigint"))).alias("n")
    windows = F.aggregate(F.filter("h", lambda r: r["at_least"] >= F.col("n")), F.lit(0).cast("bigint"),
                          lambda s, r: s + r["bins"] - (F.col("n") - 1) * r["runs"])
    return h.select("h", n).select("n", windows.alias("n_windows"))


SW = 5


@query("sliding_windows", sql=f"""
WITH {daily_panel_ctes()},
f AS (SELECT user_id, day, {", ".join(f"last_value({c} IGNORE NULLS) OVER ({W_ASC}) AS {c}" for c in D)} FROM dp),
b AS (SELECT user_id, day, {", ".join(f"coalesce({c}, first_value({c} IGNORE NULLS) OVER ({W_FWD})) AS {c}" for c in D)} FROM f),
w AS (SELECT user_id, day AS start,
        count(*) OVER fw AS n, count(heart_rate) OVER fw AS n_hr, count(fio2) OVER fw AS n_fio2,
        sum(heart_rate) OVER fw AS hr_sum, lead(fio2, {SW - 1}) OVER (PARTITION BY user_id ORDER BY day) AS fio2_last
      FROM b WINDOW fw AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND {SW - 1} FOLLOWING))
SELECT user_id, start, round(hr_sum, 6) AS hr_sum, fio2_last FROM w
WHERE n = {SW} AND n_hr = {SW} AND n_fio2 = {SW}""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete windows of 5 consecutive bins x (heart_rate, fio2) after
    ffill/bfill, stride 1; summarised by the window's heart-rate sum and
    last fio2 value."""
    filled = S.ffill_bfill(C.daily_panel(spark, sf_dir), ENTITY, "day", D)
    w = S.sliding_windows(filled, ENTITY, "day", ["heart_rate", "fio2"], SW)
    hr_sum = F.aggregate("win", F.lit(0.0), lambda acc, x: acc + x["heart_rate"])
    return w.select(ENTITY, "start", r6(hr_sum).alias("hr_sum"),
                    F.element_at("win", SW)["fio2"].alias("fio2_last"))


