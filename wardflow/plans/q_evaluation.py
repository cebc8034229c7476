"""Evaluation queries: ROC curves and calibration over all units, agreement
lines and ranges, error distribution, missingness distributions, coverage and
draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.dictionary import literal_table
from wardflow.functions.scalar import r6
from wardflow.operators import masking as M
from wardflow.operators import stats as ST
from wardflow.operators.ranks import number_rows
from wardflow.plans import common as C
from wardflow.plans import q_impute as QI
from wardflow.plans import q_sequence as QS
from wardflow.plans.q_stats import SCORED_CTE, scored
from wardflow.plans.registry import ORACLES, query
from wardflow.plans.sql_common import cohort_ctes, daily_panel_ctes, hourly_ctes
from wardflow.sources.tables import ENTITY, read_table

D = C.DAILY_COLS


def by_scope(df: DataFrame, unit: str) -> DataFrame:
    """Every row twice: in its unit, and in the whole (``scope`` unit or
    global, ``unit`` null for the latter)."""
    each = F.array(F.struct(F.lit("unit").alias("scope"), F.col(unit).cast("string").alias("unit")),
                   F.struct(F.lit("global").alias("scope"), F.lit(None).cast("string").alias("unit")))
    return df.select("*", F.inline(each))


SCOPED_CTE = f"""{SCORED_CTE},
sx AS (SELECT 'unit' AS scope, lang AS unit, score, y FROM sc UNION ALL SELECT 'global', NULL, score, y FROM sc)"""


@query("roc_curve", sql=f"""
WITH {SCOPED_CTE},
per AS (SELECT scope, unit, score, sum(y) AS pos, sum(1 - y) AS neg FROM sx GROUP BY scope, unit, score),
c AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, lead(pos) OVER d AS npos, lead(neg) OVER d AS nneg,
             sum(pos) OVER (PARTITION BY scope, unit) AS p, sum(neg) OVER (PARTITION BY scope, unit) AS n
      FROM per WINDOW d AS (PARTITION BY scope, unit ORDER BY score DESC)),
k AS (SELECT scope, unit, score AS threshold, tp, fp, p, n FROM c WHERE npos IS NULL OR npos * neg <> pos * nneg
      UNION ALL SELECT DISTINCT scope, unit, NULL, 0, 0, p, n FROM c)
SELECT scope, unit, round(threshold, 6) AS threshold, round(CASE WHEN n > 0 THEN fp / n END, 6) AS fpr,
       round(CASE WHEN p > 0 THEN tp / p END, 6) AS tpr FROM k""")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curve per unit and global: one point per distinct score,
    without those on the line between their neighbours, and the origin
    (threshold null)."""
    return ST.roc_curve(by_scope(scored(spark, sf_dir), "lang"), ["scope", "unit"], "score", "y")


@query("roc_auc", sql=f"""
WITH {SCOPED_CTE},
r AS (SELECT scope, unit, y, (2 * rank() OVER (PARTITION BY scope, unit ORDER BY score)
                              + count(*) OVER (PARTITION BY scope, unit, score) - 1) / 2.0 AS avg_rank FROM sx),
g AS (SELECT scope, unit, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg, sum(CASE WHEN y = 1 THEN avg_rank ELSE 0 END) AS rs
      FROM r GROUP BY scope, unit)
SELECT scope, unit, n_pos, n_neg, round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (rs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) END, 6) AS auc
FROM g""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve per unit and global."""
    out = ST.auc_by_group(by_scope(scored(spark, sf_dir), "lang"), ["scope", "unit"], "score", "y")
    return out.withColumns({"n_pos": F.col("n_pos").cast("bigint"), "n_neg": F.col("n_neg").cast("bigint")})


UNIFORM_BINS = 5


@query("calibration_all", sql=f"""
WITH {SCOPED_CTE},
e AS (SELECT quantile_cont(score, [{", ".join(str(k / 10) for k in range(1, 10))}]) AS edges FROM sc),
b AS (SELECT sx.*, 'quantile' AS bins, CAST(len(list_filter(list_distinct(e.edges), lambda x: x < sx.score)) AS INTEGER) AS bin FROM sx CROSS JOIN e
      UNION ALL SELECT sx.*, 'uniform', CAST(least(floor(score * {UNIFORM_BINS}), {UNIFORM_BINS - 1}) AS INTEGER) FROM sx)
SELECT bins, scope, unit, bin, count(*) AS n, round(avg(y), 6) AS observed, round(avg(score), 6) AS predicted
FROM b GROUP BY bins, scope, unit, bin""")
def calibration_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration tables, global and per unit, by deciles of the whole
    and by five uniform bins."""
    s = scored(spark, sf_dir)
    uniform = F.least(F.floor(F.col("score") * UNIFORM_BINS), F.lit(UNIFORM_BINS - 1)).cast("int")
    b = ST.quantile_bin(s, "score", 10, "quantile").withColumn("uniform", uniform)
    each = F.array(*[F.struct(F.lit(k).alias("bins"), F.col(k).alias("bin")) for k in ("quantile", "uniform")])
    return ST.calibration(by_scope(b.select("lang", "score", "y", F.inline(each)), "lang"), ["bins", "scope", "unit"], "bin", "score", "y")


@query("limit_lines", sql=f"""WITH {QI._comparison_cte()},
g AS (SELECT feature, count(*) AS n, regr_slope(diff, original) AS b1, regr_intercept(diff, original) AS b0, stddev_samp(diff) AS sd
      FROM cmp WHERE original BETWEEN {QI.LO_TRUE} AND {QI.HI_TRUE} GROUP BY feature)
SELECT feature, n, round(b1, 6) AS slope, round(b0, 6) AS intercept, round(b0 + 1.96 * sd, 6) AS upper_intercept,
       round(b0 - 1.96 * sd, 6) AS lower_intercept FROM g""")
def limit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression lines of the limits of agreement: the difference's
    slope, and its intercept shifted by 1.96 standard deviations."""
    c = QI.comparison(spark, sf_dir).filter(F.col("original").between(QI.LO_TRUE, QI.HI_TRUE))
    g = c.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.regr_slope("diff", "original").alias("b1"),
                                 F.regr_intercept("diff", "original").alias("b0"), F.stddev_samp("diff").alias("sd"))
    return g.select("feature", "n", r6("b1").alias("slope"), r6("b0").alias("intercept"), r6(F.col("b0") + 1.96 * F.col("sd")).alias("upper_intercept"),
                    r6(F.col("b0") - 1.96 * F.col("sd")).alias("lower_intercept"))


#: true values of the range-restricted agreement
RANGE = (30.0, 140.0)


@query("range_agreement", sql=f"""WITH {QI._comparison_cte()}
SELECT feature, count(*) AS n, round(avg(diff), 6) AS bias, round(stddev_samp(diff), 6) AS sd,
       round(avg(diff) - 1.96 * stddev_samp(diff), 6) AS low, round(avg(diff) + 1.96 * stddev_samp(diff), 6) AS high,
       round(avg(CASE WHEN diff BETWEEN -10 AND 10 THEN 1.0 ELSE 0.0 END), 6) AS share_within_10
FROM cmp WHERE original BETWEEN {RANGE[0]} AND {RANGE[1]} GROUP BY feature""")
def range_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of the true values within 30..140 only."""
    c = QI.comparison(spark, sf_dir).filter(F.col("original").between(*RANGE))
    sd = F.stddev_samp("diff")
    return c.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("diff")).alias("bias"), r6(sd).alias("sd"), r6(F.avg("diff") - 1.96 * sd).alias("low"),
        r6(F.avg("diff") + 1.96 * sd).alias("high"), r6(F.avg(F.col("diff").between(-10, 10).cast("double"))).alias("share_within_10"))


@query("error_distribution", sql=f"""
WITH l AS ({ORACLES["loo_residual"]}),
m AS (SELECT feature, error, avg(error) OVER (PARTITION BY feature) AS mu FROM l)
SELECT feature, count(*) AS n, round(avg(error), 6) AS mean, round(stddev_samp(error), 6) AS std,
       round(avg(power(error - mu, 3)) / power(avg(power(error - mu, 2)), 1.5), 6) AS skewness,
       round(avg(power(error - mu, 4)) / power(avg(power(error - mu, 2)), 2) - 3, 6) AS kurtosis,
       min(error) AS min, max(error) AS max FROM m GROUP BY feature""")
def error_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewness and kurtosis of the leave-one-out error per feature, next
    to its moments and extremes (``qq_positions`` has the sorted positions)."""
    e = QS.loo_residual(spark, sf_dir)
    return e.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("error")).alias("mean"), r6(F.stddev_samp("error")).alias("std"),
        r6(F.skewness("error")).alias("skewness"), r6(F.kurtosis("error")).alias("kurtosis"), F.min("error").alias("min"), F.max("error").alias("max"))


@query("missing_matrix", sql=f"""
WITH {cohort_ctes()}
SELECT day, user_id, CAST(total_missing AS INTEGER) AS total_missing FROM cp""")
def missing_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of missing variables per bin and entity, long form."""
    return C.cohort_panel(spark, sf_dir).select("day", ENTITY, F.col("total_missing").cast("int").alias("total_missing"))


@query("missing_distribution", sql=f"""
WITH {cohort_ctes()},
c AS (SELECT total_missing, count(*) AS n FROM cp WHERE max_valid_interval > 0 GROUP BY total_missing),
g AS (SELECT CAST(i AS INTEGER) AS total_missing FROM range({len(D) + 1}) r(i))
SELECT g.total_missing, coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / nullif((SELECT sum(n) FROM c), 0) * 100, 1) AS pct
FROM g LEFT JOIN c ON c.total_missing = g.total_missing""")
def missing_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: rows by number of missing variables (0 to all), counts and shares."""
    cp = C.cohort_panel(spark, sf_dir).filter(F.col("max_valid_interval") > 0)
    n = cp.groupBy(F.col("total_missing").cast("int").alias("total_missing")).agg(F.count(F.lit(1)).alias("n"))
    n = ST.attach_row(n, n.agg(F.sum("n").alias("all")))                          # one row per count
    n = n.select("total_missing", "n", F.round(F.try_divide(F.col("n"), F.col("all")) * 100, 1).alias("pct"))
    grid = literal_table(spark, [(i,) for i in range(len(D) + 1)], "total_missing int")
    out = grid.join(n, "total_missing", "left")
    return out.select("total_missing", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("pct", F.lit(0.0)).alias("pct"))


LONG_STAY = 48


@query("long_stay_coverage", sql=f"""
WITH {hourly_ctes()},
h AS (SELECT DISTINCT user_id, hour FROM hm),
g AS (SELECT user_id, max(hour) AS last_hour, count(CASE WHEN hour BETWEEN 0 AND {LONG_STAY} THEN 1 END) AS n_hours FROM h GROUP BY user_id)
SELECT user_id, last_hour, n_hours FROM g WHERE last_hour > {LONG_STAY} AND n_hours < {LONG_STAY}""")
def long_stay_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays beyond 48 hours with fewer than 48 charted hours in 0..48."""
    h = C.hourly_long(spark, sf_dir).select(ENTITY, "hour").distinct()
    g = h.groupBy(ENTITY).agg(F.max("hour").alias("last_hour"), F.count_if(F.col("hour").between(0, LONG_STAY)).alias("n_hours"))
    return g.filter((F.col("last_hour") > LONG_STAY) & (F.col("n_hours") < LONG_STAY))


DRAWS, TRAIN_DRAWS = 30_000, 20_000


def draw_rows(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """``n`` draws with replacement: ``draw`` (0-based) and the columns of the
    row drawn.  Rows are numbered along ``key`` (unique), draw ``i`` takes the
    row whose number is its uniform draw times the row count, so the result
    does not depend on partitions."""
    rows = number_rows(df, [F.col(c).asc() for c in key], None, "_row", "_rows")
    total = rows.agg(F.max("_rows").alias("n")).select("n").scalar()
    u = M.digest(seed, F.col("id")) / F.lit(float(1 << M.DRAW_BITS))
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), F.floor(u * total).alias("_row"))
    return draws.join(rows, "_row").drop("_row", "_rows")


@query("draw_with_replacement", sql=f"""
WITH r AS (SELECT event_id, user_id, value, row_number() OVER (ORDER BY event_id) - 1 AS row FROM events),
d AS (SELECT i AS draw, CAST(floor({M.digest_sql('42', 'i')} / {float(1 << M.DRAW_BITS)} * (SELECT count(*) FROM events)) AS BIGINT) AS row
      FROM range({DRAWS}) g(i))
SELECT draw, CASE WHEN draw < {TRAIN_DRAWS} THEN 'train' ELSE 'test' END AS split, event_id, user_id, value FROM d JOIN r USING (row)""")
def draw_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30,000 rows drawn with replacement, the first 20,000 draws for
    training, the others for testing."""
    ev = read_table(spark, sf_dir, "events").select("event_id", ENTITY, "value")
    d = draw_rows(ev, ["event_id"], DRAWS, 42)
    return d.select("draw", F.when(F.col("draw") < TRAIN_DRAWS, "train").otherwise("test").alias("split"), "event_id", ENTITY, "value")


@query("single_entity", sql=f"""
WITH {daily_panel_ctes()},
p AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM dp) ORDER BY {M.digest_sql('7', 'user_id')}, user_id LIMIT 1)
SELECT dp.user_id, day, {", ".join(D)} FROM dp JOIN p ON p.user_id = dp.user_id""")
def single_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the panel of one entity, drawn by the smallest digest."""
    dp = C.daily_panel(spark, sf_dir).select(ENTITY, "day", *D)
    chosen = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin([s for s, _f in C.DAILY])).select(ENTITY).agg(
        F.min_by(ENTITY, F.struct(M.digest(7, F.col(ENTITY)), F.col(ENTITY))).alias("e"))
    return dp.filter(F.col(ENTITY) == chosen.select("e").scalar())

