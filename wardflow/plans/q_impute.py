"""Masking scenarios, simple imputers, error metrics and agreement
statistics on the fixed-length cohort panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.scalar import r6, t_quantile_975_sql
from wardflow.operators import imputers as I
from wardflow.operators import masking as M
from wardflow.operators import sequence as S
from wardflow.operators import stats as ST
from wardflow.operators.models import hash_split
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.plans.sql_common import cohort_ctes
from wardflow.sources.io import write_partitions, write_scratch
from wardflow.sources.steps import Steps, fingerprint
from wardflow.sources.tables import ENTITY, read_table

D = C.DAILY_COLS
H = C.COHORT_DAYS
RATE = 0.3
# scenario name, kind, block length, only feature (None = all), seed
SCENARIOS = ([("random", "random", 1, None), ("block1", "block", 1, None), ("block2", "block", 2, None),
              ("block3", "block", 3, None)] +
             [(f"block4_{f}", "block", 4, f) for f in D])
SCENARIOS = [(s, k, n, f, 42 + i) for i, (s, k, n, f) in enumerate(SCENARIOS)]
SWEEP_RATES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
KEYS = ["scenario", ENTITY, "feature"]


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def scenario_panel(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """``(scenario, user_id, day, <features>, m_<feature>...)`` of the named
    scenarios (all by default): the random cell mask, and the block
    scenarios, each masking blocks until the target share of all its cells is
    gone.  Scenarios are rows of an array until here, so one scan of the
    written panel makes them all."""
    chosen = [s for s in SCENARIOS if names is None or s[0] in names]
    blocks = [{"scenario": s, "n": n, "only": f, "rate": RATE, "seed": seed} for s, kind, n, f, seed in chosen if kind == "block"]
    x = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    if blocks:
        x = M.target_share_hits(x, ENTITY, "day", D, blocks, H)
    hit = {b["scenario"]: i for i, b in enumerate(blocks)}
    each = []
    for name, kind, _n, only, seed in chosen:
        masked = []
        for j, c in enumerate(D):
            if kind == "random":
                value = M.random_mask(c, M.uniform_hash(F.col(ENTITY), F.col("day"), F.lit(j + 1), seed), RATE)
            else:
                value = F.when(F.col(f"_hit_{hit[name]}"), F.lit(None)).otherwise(F.col(c)) if only in (None, c) else F.col(c)
            masked.append(value.alias(f"m_{c}"))
        each.append(F.struct(F.lit(name).alias("scenario"), *masked))
    return x.select(ENTITY, "day", *D, F.inline(F.array(*each))).select("scenario", ENTITY, "day", *D, *[f"m_{c}" for c in D])


def by_feature(wide: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Wide rows as one row per feature: ``columns`` maps a new column to the
    pattern of its wide names."""
    each = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(p.format(c)).alias(n) for n, p in columns.items()]) for c in D])
    return wide.select(*keys, F.inline(each))


def masked_scenarios(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """``(scenario, user_id, day, feature, original, masked)``."""
    return by_feature(scenario_panel(spark, sf_dir, names), ["scenario", ENTITY, "day"], {"original": "{}", "masked": "m_{}"})


def imputed_scenarios(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """:func:`masked_scenarios` with the four simple imputations."""
    wide = M.impute_wide(scenario_panel(spark, sf_dir, names), ["scenario", ENTITY], "day", [f"m_{c}" for c in D])
    return by_feature(wide, ["scenario", ENTITY, "day"], {"original": "{}", "masked": "m_{}"} | {m: m + "_m_{}" for m in M.METHODS})


def comparison(spark: SparkSession, sf_dir: str, scenario: str = "random",
               method: str = "imp_linear") -> DataFrame:
    """Masked cells of one scenario/method: ``(feature, user_id, day,
    original, imputed, mean, diff)``."""
    imp = imputed_scenarios(spark, sf_dir, [scenario])
    ind = F.col("original").isNotNull() & F.col("masked").isNull()
    c = imp.filter(ind).select("feature", ENTITY, "day", "original", F.col(method).alias("imputed"))
    return c.withColumns({"mean": (F.col("original") + F.col("imputed")) / 2.0,
                          "diff": F.col("imputed") - F.col("original")})


# --------------------------------------------------------------------------
# SQL side (same chain written as CTEs)
# --------------------------------------------------------------------------

def _dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _feat_list() -> str:
    return "[" + ", ".join(f"'{f}'" for f in D) + "]"


def _u_sql(seed: str) -> str:
    key = M.digest_sql("cl.user_id", "cl.day", f"list_position({_feat_list()}, cl.feature)", seed)
    return f"({key} / {float(1 << M.DRAW_BITS)})"


def _target_share_ctes(rows: str, lengths: list[int], panel: str = "cp") -> str:
    """CTEs up to ``bm(scenario, only_feature, user_id, day, <features>, hit)``
    for scenario rows ``(scenario, n, only_feature, rate, seed)``."""
    w = "PARTITION BY scenario, user_id ORDER BY day ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
    cover = " ".join(f"WHEN {n} THEN min(sk) OVER ({w.format(n - 1)})" for n in lengths)
    obs = " + ".join(f"CAST({c} IS NOT NULL AND (only_feature IS NULL OR only_feature = '{c}') AS BIGINT)" for c in D)
    return f"""sb(scenario, n, only_feature, rate, seed) AS (VALUES {rows}),
bk AS (SELECT sb.*, p.user_id, p.day, {", ".join(f"p.{c}" for c in D)}, CASE WHEN p.day < {H - 1} THEN
         {{'h': {M.digest_sql("sb.seed", "p.user_id", "p.day")}, 'e': p.user_id, 't': p.day}} END AS sk FROM {panel} p CROSS JOIN sb),
bx AS (SELECT *, CASE WHEN day < {H - 1} THEN CASE n {cover} END END AS cover, {obs} AS obs FROM bk),
bc AS (SELECT scenario, cover, sum(sum(obs)) OVER (PARTITION BY scenario ORDER BY cover) AS cum FROM bx
       WHERE cover IS NOT NULL GROUP BY scenario, cover),
bg AS (SELECT scenario, floor(sum(CASE WHEN only_feature IS NULL THEN {len(D)} ELSE 1 END) * max(rate)) AS goal FROM bk GROUP BY scenario),
bt AS (SELECT scenario, coalesce(min(CASE WHEN cum >= goal THEN cover END), max(cover)) AS thr FROM bc JOIN bg USING (scenario) GROUP BY scenario),
bm AS (SELECT bx.*, coalesce(cover <= thr, FALSE) AS hit FROM bx LEFT JOIN bt USING (scenario))"""


def _masked_cell(c: str) -> str:
    return f"CASE WHEN hit AND (only_feature IS NULL OR only_feature = '{c}') THEN NULL ELSE {c} END"


def _hash_split_sql(key: str) -> str:
    h = f"CAST(floor({M.digest_sql(key, '42')} / {float(1 << M.DRAW_BITS)} * CAST(100 AS DOUBLE)) AS BIGINT)"
    return f"CASE WHEN {h} < 70 THEN 'train' WHEN {h} < 85 THEN 'val' ELSE 'test' END"


def _cl_cte() -> str:
    return f"""{cohort_ctes()},
cl AS ({" UNION ALL ".join(f"SELECT user_id, day, '{c}' AS feature, {c} AS original FROM cp" for c in D)})"""


def _masked_ctes() -> str:
    random, *blocks = SCENARIOS
    rows = ", ".join(f"('{s}', {n}, {'NULL' if f is None else repr(f)}, {_dbl(RATE)}, {seed})" for s, _k, n, f, seed in blocks)
    long = " UNION ALL ".join(f"SELECT scenario, user_id, day, '{c}' AS feature, {c} AS original, {_masked_cell(c)} AS masked FROM bm"
                              for c in D)
    return f"""{_cl_cte()},
{_target_share_ctes(rows, sorted({b[2] for b in blocks}))},
m AS (SELECT '{random[0]}' AS scenario, user_id, day, feature, original,
        CASE WHEN {_u_sql(str(random[-1]))} < {_dbl(RATE)} THEN NULL ELSE original END AS masked FROM cl
      UNION ALL {long})"""


def _impute_ctes(src: str = "m", keys: str = "scenario, user_id, feature") -> str:
    wa = f"PARTITION BY {keys} ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    wf = f"PARTITION BY {keys} ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""i0 AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY day) AS i FROM {src}),
i1 AS (SELECT *, avg(masked) OVER (PARTITION BY {keys}) AS mmean,
         median(masked) OVER (PARTITION BY {keys}) AS mmed,
         last_value(masked IGNORE NULLS) OVER ({wa}) AS pv,
         last_value(CASE WHEN masked IS NOT NULL THEN i END IGNORE NULLS) OVER ({wa}) AS pi,
         first_value(masked IGNORE NULLS) OVER ({wf}) AS nv,
         first_value(CASE WHEN masked IS NOT NULL THEN i END IGNORE NULLS) OVER ({wf}) AS ni
       FROM i0),
imp AS (SELECT *, coalesce(masked, mmean) AS imp_mean, coalesce(masked, mmed) AS imp_median,
          coalesce(pv, nv) AS imp_locf,
          CASE WHEN masked IS NOT NULL THEN masked
               ELSE coalesce(pv + (nv - pv) * (CAST(i - pi AS DOUBLE) / (ni - pi)), pv, nv) END AS imp_linear
        FROM i1)"""


def _comparison_cte() -> str:
    return f"""{_masked_ctes()},
{_impute_ctes()},
cmp AS (SELECT feature, user_id, day, original, imp_linear AS imputed, (original + imp_linear) / 2.0 AS mean,
               imp_linear - original AS diff
        FROM imp WHERE scenario = 'random' AND original IS NOT NULL AND masked IS NULL)"""


def _err_sql(group: str, src: str) -> str:
    return (f"SELECT {group}, count(d) AS n, round(avg(abs(d)), 6) AS mae, round(sqrt(avg(d * d)), 6) AS rmse "
            f"FROM {src} GROUP BY {group}")


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------

@query("mask_random", sql=f"""WITH {_cl_cte()}
SELECT user_id, day, feature, original,
       CASE WHEN {_u_sql("42")} < {_dbl(RATE)} THEN NULL ELSE original END AS masked FROM cl""")
def mask_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5, one pass of J1: MCAR mask at rate 0.3 from a deterministic hash per cell."""
    long = C.cohort_long(spark, sf_dir)
    u = M.uniform_hash(F.col(ENTITY), F.col("day"), M.feature_index("feature", D), 42)
    return long.select(ENTITY, "day", "feature", "original", M.random_mask("original", u, RATE).alias("masked"))


@query("mask_blocks", sql=f"""WITH {_masked_ctes()}
SELECT scenario, user_id, day, feature, original, masked FROM m WHERE scenario LIKE 'block%'""")
def mask_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block masks of 1-3 bins on all features and 4-bin blocks on
    one feature at a time, until 30 % of the cells are gone (last bin never
    masked)."""
    return masked_scenarios(spark, sf_dir, [s[0] for s in SCENARIOS if s[1] == "block"])


@query("scenario_errors", sql=f"""WITH {_masked_ctes()},
{_impute_ctes()},
u AS (UNPIVOT (SELECT scenario, original, masked, imp_mean, imp_median, imp_locf, imp_linear FROM imp)
      ON imp_mean, imp_median, imp_locf, imp_linear INTO NAME method VALUE imputed),
e AS (SELECT scenario, method, CASE WHEN original IS NOT NULL AND masked IS NULL THEN imputed - original END AS d FROM u)
{_err_sql("scenario, method", "e")}""")
def scenario_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight masking scenarios x four imputers (per-series
    mean, median, LOCF+NOCB, linear), MAE/RMSE on the indicating mask."""
    imp = imputed_scenarios(spark, sf_dir)
    long = imp.unpivot(["scenario", "original", "masked"], M.METHODS, "method", "imputed")
    return M.errors(long, ["scenario", "method"], "original", "masked", "imputed")


@query("feature_errors", sql=f"""WITH {_masked_ctes()},
{_impute_ctes()},
e AS (SELECT scenario, feature, CASE WHEN original IS NOT NULL AND masked IS NULL THEN imp_linear - original END AS d
      FROM imp)
{_err_sql("scenario, feature", "e")}""")
def feature_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: MAE/RMSE per scenario and feature on the original scale (linear
    imputer)."""
    return M.errors(imputed_scenarios(spark, sf_dir), ["scenario", "feature"], "original", "masked", "imp_linear")


def _sweep_sql() -> str:
    rows = ", ".join(f"('{r}|{f}', 1, '{f}', {_dbl(r)}, 42)" for r in SWEEP_RATES for f in D)
    long = " UNION ALL ".join(f"SELECT rate, user_id, day, '{c}' AS feature, {c} AS original, {_masked_cell(c)} AS masked FROM bm "
                              f"WHERE only_feature = '{c}'" for c in D)
    return f"""WITH {cohort_ctes()},
{_target_share_ctes(rows, [1])},
m AS ({long}),
{_impute_ctes("m", "rate, user_id, feature")},
e AS (SELECT rate, feature, CASE WHEN original IS NOT NULL AND masked IS NULL THEN imp_linear - original END AS d
      FROM imp)
{_err_sql("rate, feature", "e")}"""


@query("rate_sweep", sql=_sweep_sql())
def rate_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-bin blocks on one feature at a time until 0.1..0.8 of its
    cells are gone; linear-imputation error per rate and feature."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    rows = [{"scenario": f"{r}|{f}", "n": 1, "only": f, "rate": r, "seed": 42} for r in SWEEP_RATES for f in D]
    x = M.target_share_hits(cp, ENTITY, "day", D, rows, H)
    each = [F.struct(F.lit(r).alias("rate"), *[F.when(F.col(f"_hit_{i * len(D) + j}"), F.lit(None)).otherwise(F.col(c)).alias(f"m_{c}")
                                               for j, c in enumerate(D)]) for i, r in enumerate(SWEEP_RATES)]
    wide = x.select(ENTITY, "day", *D, F.inline(F.array(*each)))
    wide = M.impute_wide(wide, ["rate", ENTITY], "day", [f"m_{c}" for c in D])
    imp = by_feature(wide, ["rate"], {"original": "{}", "masked": "m_{}", "imp_linear": "imp_linear_m_{}"})
    return M.errors(imp, ["rate", "feature"], "original", "masked", "imp_linear")


@query("error_by_run_pos", sql=f"""WITH {_masked_ctes()},
{_impute_ctes()},
rr AS (SELECT *, row_number() OVER (PARTITION BY scenario, user_id, feature ORDER BY day)
            - row_number() OVER (PARTITION BY scenario, user_id, feature, masked IS NULL ORDER BY day) AS run FROM imp),
p AS (SELECT *, sum(CAST(masked IS NULL AS INTEGER)) OVER (PARTITION BY scenario, user_id, feature, masked IS NULL, run
                ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos FROM rr WHERE scenario = 'random'),
u AS (UNPIVOT (SELECT pos, original, masked, imp_mean, imp_median, imp_locf, imp_linear FROM p
               WHERE original IS NOT NULL AND masked IS NULL AND pos <= 3)
      ON imp_mean, imp_median, imp_locf, imp_linear INTO NAME method VALUE imputed)
SELECT method, CAST(pos AS BIGINT) AS pos, count(*) AS n, round(avg(abs(imputed - original)), 6) AS mae FROM u
GROUP BY method, pos""")
def error_by_run_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputation error by position inside the masked run (1..3),
    melted by method."""
    imp = imputed_scenarios(spark, sf_dir, ["random"])
    p = S.position_in_run(imp, KEYS, "day", "masked", "pos")
    p = p.filter(F.col("original").isNotNull() & F.col("masked").isNull() & (F.col("pos") <= 3))
    long = p.unpivot(["pos", "original"], M.METHODS, "method", "imputed")
    return long.groupBy("method", F.col("pos").cast("bigint").alias("pos")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(F.abs(F.col("imputed") - F.col("original")))).alias("mae"))


@query("bland_altman", sql=f"""WITH {_comparison_cte()}
SELECT feature, count(diff) AS n, round(avg(diff), 6) AS bias, round(stddev_samp(diff), 6) AS sd,
       round(avg(diff) - 1.96 * stddev_samp(diff), 6) AS loa_low, round(avg(diff) + 1.96 * stddev_samp(diff), 6) AS loa_high
FROM cmp GROUP BY feature""")
def bland_altman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: Bland-Altman bias, SD and limits of agreement per feature."""
    return ST.bland_altman(comparison(spark, sf_dir), ["feature"], "original", "imputed")


@query("agreement_bands", sql=f"""WITH {_comparison_cte()}
SELECT feature, CAST(ceil(original / 10.0) AS BIGINT) AS band, count(*) AS n, round(avg(diff), 6) AS mean_diff,
       round(stddev_samp(diff), 6) AS sd_diff,
       round(avg(diff) - 2 * stddev_samp(diff), 6) AS low, round(avg(diff) + 2 * stddev_samp(diff), 6) AS high,
       round(avg(CASE WHEN diff BETWEEN -10 AND 10 THEN 1.0 ELSE 0.0 END), 6) AS share_within_10
FROM cmp GROUP BY feature, CAST(ceil(original / 10.0) AS BIGINT)""")
def agreement_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K13 and the bands of K12 (``range_agreement``): agreement by value band of width 10, mean +- 2 SD, share of
    differences within +-10."""
    c = comparison(spark, sf_dir)
    return c.groupBy("feature", F.ceil(F.col("original") / 10.0).cast("bigint").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("diff")).alias("mean_diff"), r6(F.stddev_samp("diff")).alias("sd_diff"),
        r6(F.avg("diff") - 2 * F.stddev_samp("diff")).alias("low"),
        r6(F.avg("diff") + 2 * F.stddev_samp("diff")).alias("high"),
        r6(F.avg(F.col("diff").between(-10, 10).cast("double"))).alias("share_within_10"))


TAIL = 55.0


@query("tail_error", sql=f"""WITH {_comparison_cte()}
SELECT feature, count(*) AS n, round(avg(abs(diff)), 6) AS mae, round(sqrt(avg(diff * diff)), 6) AS rmse,
       count(CASE WHEN original < {TAIL} THEN 1 END) AS n_tail,
       round(avg(CASE WHEN original < {TAIL} THEN abs(diff) END), 6) AS mae_tail,
       round(sqrt(avg(CASE WHEN original < {TAIL} THEN diff * diff END)), 6) AS rmse_tail
FROM cmp GROUP BY feature""")
def tail_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error in the low tail (original < 55) next to the overall error."""
    c = comparison(spark, sf_dir)
    tail = F.col("original") < TAIL
    return c.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(F.abs("diff"))).alias("mae"),
        r6(F.sqrt(F.avg(F.col("diff") * F.col("diff")))).alias("rmse"), F.count_if(tail).alias("n_tail"),
        r6(F.avg(F.when(tail, F.abs("diff")))).alias("mae_tail"),
        r6(F.sqrt(F.avg(F.when(tail, F.col("diff") * F.col("diff"))))).alias("rmse_tail"))


def _t975_sql(v: str) -> str:
    return t_quantile_975_sql(v)


#: range of true values of the regression
LO_TRUE, HI_TRUE = 20.0, 160.0


@query("regression_ci", sql=f"""WITH {_comparison_cte()},
g AS (SELECT feature, regr_count(diff, original) AS n, regr_slope(diff, original) AS b1, regr_intercept(diff, original) AS b0,
             regr_sxx(diff, original) AS sxx, regr_syy(diff, original) AS syy, regr_sxy(diff, original) AS sxy,
             regr_avgx(diff, original) AS mx FROM cmp WHERE original BETWEEN {LO_TRUE} AND {HI_TRUE} GROUP BY feature),
h AS (SELECT *, sqrt(((syy - b1 * sxy) / (n - 2)) / sxx) AS se1,
             sqrt(((syy - b1 * sxy) / (n - 2)) * (1.0 / n + mx * mx / sxx)) AS se0, {_t975_sql("n - 2")} AS t FROM g)
SELECT feature, CAST(n AS BIGINT) AS n, round(b1, 6) AS slope, round(b0, 6) AS intercept, round(se1, 6) AS se_slope,
       round(se0, 6) AS se_intercept, round(b1 - t * se1, 6) AS slope_lo, round(b1 + t * se1, 6) AS slope_hi,
       round(b0 - t * se0, 6) AS intercept_lo, round(b0 + t * se0, 6) AS intercept_hi FROM h""")
def regression_ci(spark: SparkSession, sf_dir: str, lo: float = LO_TRUE, hi: float = HI_TRUE) -> DataFrame:
    """Regression of the difference on the true (masked) value within
    ``[lo, hi]``, with standard errors and 95 % intervals (one pass of regr_*
    aggregates)."""
    c = comparison(spark, sf_dir).filter(F.col("original").between(lo, hi))
    return ST.regression_ci(c, ["feature"], "diff", "original")


@query("density_2d", sql=f"""WITH {_comparison_cte()},
b AS (SELECT feature, CAST(floor(mean / 10.0) AS BIGINT) AS mean_bin, CAST(floor(diff / 10.0) AS BIGINT) AS diff_bin,
             count(*) AS n FROM cmp GROUP BY 1, 2, 3)
SELECT feature, mean_bin, diff_bin, n, round(n / max(n) OVER (PARTITION BY feature), 6) AS rel_density FROM b""")
def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binned 2-D density of (mean, difference), max-normalised per
    feature (replaces a point-wise kernel density)."""
    c = comparison(spark, sf_dir)
    b = c.groupBy("feature", F.floor(F.col("mean") / 10.0).alias("mean_bin"),
                  F.floor(F.col("diff") / 10.0).alias("diff_bin")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("feature")
    return b.withColumn("rel_density", r6(F.col("n") / F.max("n").over(w)))


def _first_pass_sql(c: str, j: int) -> str:
    draws = " ".join(f"WHEN {M.digest_sql('user_id', 'day', str(j), '42', str(k))} / {float(1 << M.DRAW_BITS)} < {_dbl(RATE / 2 ** k)} THEN {k}" for k in range(M.PASSES))
    return f"CASE WHEN {c} IS NOT NULL THEN CASE {draws} END END"


@query("mask_random_target", sql=f"""WITH {cohort_ctes()},
f AS (SELECT user_id, day, {", ".join(D)}, {", ".join(f"{_first_pass_sql(c, j + 1)} AS first_{c}" for j, c in enumerate(D))} FROM cp),
l AS ({" UNION ALL ".join(f"SELECT first_{c} AS k FROM f WHERE {c} IS NOT NULL" for c in D)}),
p AS (SELECT i AS k, (SELECT count(*) FROM l) - (SELECT count(*) FROM l WHERE l.k < i) AS remaining FROM range({M.PASSES + 1}) r(i)),
n AS (SELECT coalesce(min(k), {M.PASSES}) AS passes FROM p WHERE remaining <= (SELECT count(*) FROM l) * (1 - {_dbl(RATE)}))
SELECT user_id, day, {", ".join(f"CASE WHEN first_{c} < passes THEN NULL ELSE {c} END AS m_{c}" for c in D)} FROM f, n""")
def mask_random_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random cells masked, again and again at half the rate, until 30 % of
    the observed ones are gone."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    out = M.masked_panel(cp, ENTITY, "day", D, M.random_until_target, rate=RATE, seed=42)
    return out.select(ENTITY, "day", *[f"m_{c}" for c in D])


J2_N = 2


@query("mask_blocks_counted", sql=f"""WITH {cohort_ctes()},
e AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS no FROM (SELECT DISTINCT user_id FROM cp)),
d AS (SELECT CAST(floor({M.digest_sql('42', 'i', '0')} / {float(1 << M.DRAW_BITS)} * (SELECT count(*) FROM e)) AS BIGINT) AS no,
             CAST(floor({M.digest_sql('42', 'i', '1')} / {float(1 << M.DRAW_BITS)} * {H}) AS BIGINT) AS t0
      FROM (SELECT unnest(range(CAST(floor((SELECT count(*) FROM e) * {H} * {_dbl(RATE)} / {J2_N}) AS BIGINT))) AS i)),
h AS (SELECT DISTINCT e.user_id, unnest(range(t0, least(t0 + {J2_N}, {H - 1}))) AS day FROM d JOIN e USING (no) WHERE t0 < {H - 1})
SELECT cp.user_id, cp.day, {", ".join(f"CASE WHEN h.day IS NOT NULL THEN NULL ELSE {c} END AS m_{c}" for c in D)}
FROM cp LEFT JOIN h ON h.user_id = cp.user_id AND h.day = cp.day""")
def mask_blocks_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counted number of two-bin blocks on all features, drawn with
    replacement (the last bin never masked)."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    out = M.masked_panel(cp, ENTITY, "day", D, M.counted_blocks, n=J2_N, horizon=H, rate=RATE, seed=42)
    return out.select(ENTITY, "day", *[f"m_{c}" for c in D])


J3_N, J3_SEED = 3, 42


@query("mask_target_share", sql=f"""WITH {cohort_ctes()},
{_target_share_ctes(f"('s', {J3_N}, NULL, {_dbl(RATE)}, {J3_SEED})", [J3_N])}
SELECT user_id, day, {", ".join(f"{_masked_cell(c)} AS m_{c}" for c in D)} FROM bm""")
def mask_target_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-bin blocks on all features added in hash order until 30 % of
    the cells' count of observed values is newly masked (exact, no
    sequential loop)."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    out = M.target_share_block_mask(cp, ENTITY, "day", D, J3_N, H, RATE, J3_SEED)
    return out.select(ENTITY, "day", *[f"m_{c}" for c in D])


#: entities of the training set are those of :func:`wardflow.operators.models.hash_split`
def fitted_imputers(cohort: DataFrame, rounds: int = 30) -> dict:
    """Chained regressions and chained forests fitted on the unmasked rows of
    the training entities."""
    train = write_scratch(cohort.filter(hash_split(F.col(ENTITY)) == "train").select(*D), "train")
    return {"mice": I.ChainedLinear(D, max_rounds=rounds).fit(train), "forest": I.ChainedForest(D).fit(train)}


def model_imputations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """``(scenario, user_id, day, feature, original, masked, imp_<method>...)``
    of the entities outside the training set, by the four simple imputers and
    the two fitted ones, and the fitted imputers."""
    models = fitted_imputers(C.cohort_panel(spark, sf_dir))
    held = scenario_panel(spark, sf_dir).filter(hash_split(F.col(ENTITY)) != "train")
    masked = [f"m_{c}" for c in D]
    x = M.impute_wide(held, ["scenario", ENTITY], "day", masked)
    for name, model in models.items():
        row = F.struct(*[F.col(c) for c in x.columns])
        y = x.select(row.alias("row"), *[F.col(f"m_{c}").alias(c) for c in D])
        x = model.transform(y).select("row.*", *[F.col(c).alias(f"imp_{name}_m_{c}") for c in D])
    methods = [*M.METHODS, *[f"imp_{m}" for m in models]]
    long = by_feature(x, ["scenario", ENTITY, "day"], {"original": "{}", "masked": "m_{}"} | {m: m + "_m_{}" for m in methods})
    return long, models


@query("model_scenario_errors")
def model_scenario_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9/J10 in J4/K7: chained regressions (30 rounds at most) and chained
    forests, fitted on the training entities, next to the simple imputers in
    all eight scenarios of the other entities; rounds run and whether the fit
    converged (null for the simple ones)."""
    long, models = model_imputations(spark, sf_dir)
    methods = [*M.METHODS, *[f"imp_{m}" for m in models]]
    e = M.errors(long.unpivot(["scenario", "original", "masked"], methods, "method", "imputed"), ["scenario", "method"], "original", "masked", "imputed")
    rounds = F.create_map(*[F.lit(v) for m, f in models.items() for v in (f"imp_{m}", f.rounds)])
    ended = F.create_map(*[F.lit(v) for m, f in models.items() for v in (f"imp_{m}", f.converged)])
    return e.withColumns({"rounds": F.try_element_at(rounds, F.col("method")), "converged": F.try_element_at(ended, F.col("method"))})


@query("model_imputed_cells", sql=f"""WITH {_masked_ctes()}
SELECT scenario, method, count(CASE WHEN original IS NOT NULL AND masked IS NULL THEN 1 END) AS n_masked, count(*) AS n_filled,
       count(masked) AS n_kept, CAST(0 AS BIGINT) AS n_changed
FROM m, (VALUES ('imp_mice'), ('imp_forest')) v(method) WHERE NOT ({_hash_split_sql("user_id")} = 'train') GROUP BY scenario, method""")
def model_imputed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per scenario and fitted imputer the masked, filled, kept and
    (none) changed cells of the entities outside the training set."""
    long, models = model_imputations(spark, sf_dir)
    x = long.unpivot(["scenario", "original", "masked"], [f"imp_{m}" for m in models], "method", "imputed")
    return x.groupBy("scenario", "method").agg(
        F.count_if(F.col("original").isNotNull() & F.col("masked").isNull()).alias("n_masked"), F.count("imputed").alias("n_filled"),
        F.count("masked").alias("n_kept"), F.count_if(F.col("masked") != F.col("imputed")).alias("n_changed"))


def materialise_imputations(panel: DataFrame, path: str) -> None:
    """The scenarios of ``panel`` x methods as ONE Parquet table
    partitioned by (scenario, method) -- readers prune to the combination they
    need.  Partitions are overwritten one by one: writing some scenarios anew
    leaves the others."""
    wide = M.impute_wide(panel, ["scenario", ENTITY], "day", [f"m_{c}" for c in D])
    imp = by_feature(wide, ["scenario", ENTITY, "day"], {"original": "{}", "masked": "m_{}"} | {m: m + "_m_{}" for m in M.METHODS})
    long = imp.unpivot(["scenario", ENTITY, "day", "feature", "original", "masked"], M.METHODS, "method", "imputed")
    write_partitions(long, path, ["scenario", "method"])


@query("imputation_table", sql=f"""WITH {_masked_ctes()},
{_impute_ctes()},
u AS (UNPIVOT (SELECT scenario, original, masked, imp_mean, imp_median, imp_locf, imp_linear FROM imp)
      ON imp_mean, imp_median, imp_locf, imp_linear INTO NAME method VALUE imputed)
SELECT scenario, method, count(*) AS n_imputed, round(avg(imputed), 6) AS mean_imputed FROM u GROUP BY scenario, method""")
def imputation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The imputed cells written step by step, a scenario at a time,
    into one table partitioned by scenario and method (a step that is complete
    is skipped when the run is repeated), and read back: cells with a value and
    their mean per partition."""
    steps = Steps(spark, "imputations " + fingerprint(read_table(spark, sf_dir, "events")))
    path = steps.path("table")
    panel = steps.table("panel", lambda: scenario_panel(spark, sf_dir))
    for name, *_ in SCENARIOS:
        steps.once(name, lambda name=name: materialise_imputations(panel.filter(F.col("scenario") == name), path))
    t = spark.read.parquet(path).filter("imputed IS NOT NULL")
    return t.groupBy("scenario", "method").agg(F.count("imputed").alias("n_imputed"), r6(F.avg("imputed")).alias("mean_imputed"))
