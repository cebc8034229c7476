"""Cohort statistics, classifier metrics and missingness queries."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.scalar import r6, whole_days_between
from wardflow.operators import stats as ST
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.plans.sql_common import cohort_ctes, daily_panel_ctes
from wardflow.sources.tables import ENTITY, read_table

D = C.DAILY_COLS
SCORE_SCALE = 2500.0   # predicted probability = n_chars / (n_chars + SCORE_SCALE)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x labels: ``(doc_id, lang, score, y)``."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return d.join(lab, "doc_id").select(
        "doc_id", "lang", (F.col("n_chars") / (F.col("n_chars") + F.lit(SCORE_SCALE))).alias("score"), "y")


SCORED_CTE = f"""sc AS (SELECT d.doc_id, d.lang, d.n_chars / (d.n_chars + {SCORE_SCALE}) AS score, l.quality AS y
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("roc_auc_by_group", sql=f"""
WITH {SCORED_CTE},
r AS (SELECT lang, y, (2 * rank() OVER (PARTITION BY lang ORDER BY score)
                       + count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS avg_rank FROM sc),
g AS (SELECT lang, sum(y) AS n_pos, sum(1 - y) AS n_neg, sum(CASE WHEN y = 1 THEN avg_rank ELSE 0 END) AS rs
      FROM r GROUP BY lang)
SELECT lang, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
       round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (rs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) END, 6) AS auc
FROM g""")
def roc_auc_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of K16 (``roc_curve``, ``roc_auc``): tie-corrected AUC per unit (language), from per-score counts."""
    out = ST.auc_by_group(scored(spark, sf_dir), ["lang"], "score", "y")
    return out.withColumns({"n_pos": F.col("n_pos").cast("bigint"), "n_neg": F.col("n_neg").cast("bigint")})


@query("pr_f2", sql=f"""
WITH {SCORED_CTE},
per AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos) OVER () AS p_all FROM per),
m AS (SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p_all AS recall FROM c),
f AS (SELECT *, CASE WHEN 4 * precision + recall <> 0 THEN 5 * precision * recall / (4 * precision + recall) END AS f2 FROM m)
SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f2, 6) AS f2
FROM f ORDER BY coalesce(f2, -1) DESC, threshold ASC LIMIT 1""")
def pr_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision-recall over distinct thresholds, best F2 threshold
    (first maximum over ascending thresholds)."""
    return ST.best_threshold(ST.pr_curve(scored(spark, sf_dir), "score", "y"))


@query("quantile_bins_calibration", sql=f"""
WITH {SCORED_CTE},
e AS (SELECT quantile_cont(score, [{", ".join(str(k / 10) for k in range(1, 10))}]) AS edges FROM sc),
b AS (SELECT sc.*, CAST(len(list_filter(list_distinct(e.edges), lambda x: x < sc.score)) AS INTEGER) AS bin FROM sc CROSS JOIN e)
SELECT lang, bin, count(*) AS n, round(avg(y), 6) AS observed, round(avg(score), 6) AS predicted
FROM b GROUP BY lang, bin""")
def quantile_bins_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D19 and part of D20 (``calibration_all``): decile bins of the predicted score (right-closed, first bin
    includes the minimum) and per-unit calibration table."""
    b = ST.quantile_bin(scored(spark, sf_dir), "score", 10)
    return ST.calibration(b, ["lang"], "bin", "score", "y")


@query("confusion", sql=f"""
WITH {SCORED_CTE},
g AS (SELECT a.label, b.pred FROM (VALUES (0), (1)) a(label) CROSS JOIN (VALUES (0), (1)) b(pred)),
c AS (SELECT y AS label, CAST(score > 0.5 AS INTEGER) AS pred, count(*) AS n FROM sc GROUP BY 1, 2)
SELECT g.label, g.pred, coalesce(c.n, 0) AS n FROM g LEFT JOIN c ON g.label = c.label AND g.pred = c.pred""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2x2 confusion counts at threshold 0.5 (complete grid)."""
    s = scored(spark, sf_dir)
    return ST.confusion(s, "y", F.col("score") > 0.5)


@query("class_report", sql=f"""
WITH {SCORED_CTE},
p AS (SELECT y, CAST(score > 0.5 AS INTEGER) AS pred FROM sc),
k AS (SELECT c.cls, sum(CASE WHEN pred = c.cls AND y = c.cls THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN pred = c.cls THEN 1 ELSE 0 END) AS npred,
             sum(CASE WHEN y = c.cls THEN 1 ELSE 0 END) AS support,
             avg(CASE WHEN pred = y THEN 1.0 ELSE 0.0 END) AS accuracy
      FROM p CROSS JOIN (VALUES (0), (1)) c(cls) GROUP BY c.cls)
SELECT cls, CAST(support AS BIGINT) AS support, round(CASE WHEN npred > 0 THEN tp / npred END, 6) AS precision,
       round(CASE WHEN support > 0 THEN tp / support END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / (npred + support) END, 6) AS f1, round(accuracy, 6) AS accuracy
FROM k""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision / recall / F1 / support and accuracy."""
    s = scored(spark, sf_dir).select("y", (F.col("score") > 0.5).cast("int").alias("pred"))
    aggs = []
    for cls in (0, 1):
        aggs += [F.sum(((F.col("pred") == cls) & (F.col("y") == cls)).cast("int")).alias(f"tp{cls}"),
                 F.sum((F.col("pred") == cls).cast("int")).alias(f"np{cls}"),
                 F.sum((F.col("y") == cls).cast("int")).alias(f"su{cls}")]
    a = s.agg(*aggs, F.avg((F.col("pred") == F.col("y")).cast("double")).alias("acc"))
    rows = [F.struct(F.lit(cls).alias("cls"), F.col(f"su{cls}").cast("bigint").alias("support"),
                     F.col(f"tp{cls}").alias("tp"), F.col(f"np{cls}").alias("npred")) for cls in (0, 1)]
    x = a.select(F.inline(F.array(*rows)), "acc")
    return x.select("cls", "support",
                    r6(F.when(F.col("npred") > 0, F.col("tp") / F.col("npred"))).alias("precision"),
                    r6(F.when(F.col("support") > 0, F.col("tp") / F.col("support"))).alias("recall"),
                    r6(F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("npred") + F.col("support"))))
                    .alias("f1"), r6("acc").alias("accuracy"))


# --------------------------------------------------------------------------
# descriptive statistics
# --------------------------------------------------------------------------

PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLS:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS null_count,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@query("profile", sql=_profile_sql())
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset profile (count, nulls, mean, std, min, quartiles, max)
    for several columns in one aggregation pass."""
    return ST.profile(read_table(spark, sf_dir, "lineitem"), PROFILE_COLS)


@query("table_one", sql="""
WITH n AS (SELECT count(*) AS total FROM customer)
SELECT 'c_mktsegment' AS variable, c_mktsegment AS level, count(*) AS n,
       round(count(*) * 100.0 / n.total, 1) AS pct, NULL::DOUBLE AS mean, NULL::DOUBLE AS sd, NULL::BIGINT AS n_missing
FROM customer CROSS JOIN n GROUP BY c_mktsegment, n.total
UNION ALL
SELECT 'c_acctbal', NULL, count(c_acctbal), NULL, round(avg(c_acctbal), 2), round(stddev_samp(c_acctbal), 2),
       count(*) - count(c_acctbal) FROM customer""")
def table_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort table -- categorical n (%) and numeric mean (SD) with
    missing counts."""
    c = read_table(spark, sf_dir, "customer")
    total = c.agg(F.count(F.lit(1)).alias("_total"))
    cat = ST.attach_row(c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), total).select(
        F.lit("c_mktsegment").alias("variable"), F.col("c_mktsegment").alias("level"), "n",
        F.round(F.col("n") * 100.0 / F.col("_total"), 1).alias("pct"))
    num = c.agg(F.count("c_acctbal").alias("n"), F.round(F.avg("c_acctbal"), 2).alias("mean"),
                F.round(F.stddev_samp("c_acctbal"), 2).alias("sd"),
                F.count_if(F.col("c_acctbal").isNull()).alias("n_missing")).select(
        F.lit("c_acctbal").alias("variable"), F.lit(None).cast("string").alias("level"), "n", "mean", "sd",
        "n_missing")
    return cat.unionByName(num, allowMissingColumns=True)


@query("histogram", sql="""
SELECT CAST(floor(l_extendedprice / 5000.0) AS BIGINT) AS bin, count(*) AS n FROM lineitem
WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width histogram."""
    from wardflow.operators.relational import histogram as hist
    return hist(read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 5000.0)


@query("box_stats", sql="""
SELECT l_returnflag, min(l_quantity) AS q0, round(quantile_cont(l_quantity, 0.25), 6) AS q1,
       round(quantile_cont(l_quantity, 0.5), 6) AS q2, round(quantile_cont(l_quantity, 0.75), 6) AS q3,
       max(l_quantity) AS q4
FROM lineitem GROUP BY l_returnflag""")
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-number summary per group (exact interpolated quartiles)."""
    li = read_table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag").agg(F.min("l_quantity").alias("q0"), F.max("l_quantity").alias("q4"))
    q = ST.exact_quantiles(li, "l_quantity", [0.25, 0.5, 0.75], group=["l_returnflag"])
    return g.join(q, "l_returnflag").select(
        "l_returnflag", "q0", *[r6(F.col("q")[i]).alias(f"q{i + 1}") for i in range(3)], "q4")


@query("value_counts", sql="""
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority HAVING count(*) > 900""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts with a having filter."""
    from wardflow.operators.relational import value_counts as vc
    return vc(read_table(spark, sf_dir, "orders"), "o_orderpriority", 900).withColumnRenamed("n", "n")


@query("threshold_sweep", sql=f"""
WITH {C.STAYS_CTE},
l AS (SELECT date_sub('day', in_time, out_time) AS los FROM stays WHERE out_time IS NOT NULL)
SELECT r.i AS threshold, count(l.los) AS n_below
FROM range(1, 11) r(i) LEFT JOIN l ON l.los < r.i GROUP BY r.i""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For thresholds 1..10 days, the number of closed stays shorter
    than the threshold -- a histogram of lengths whose rows explode the
    thresholds they count toward (equi-joins only)."""
    st = C.stays(spark, sf_dir).filter(F.col("out_time").isNotNull())
    los = whole_days_between("in_time", "out_time")
    hist = st.groupBy(los.alias("los")).agg(F.count(F.lit(1)).alias("_n"))
    # each length counts toward thresholds los+1..10 (generator, no range join)
    lo = F.greatest(F.col("los") + 1, F.lit(1)).cast("bigint")
    contrib = (hist.filter(lo <= 10)
               .select(F.explode(F.sequence(lo, F.lit(10).cast("bigint"))).alias("threshold"), "_n")
               .groupBy("threshold").agg(F.sum("_n").alias("_n")))
    thr = spark.range(1, 11).withColumnRenamed("id", "threshold")
    return (thr.join(contrib, "threshold", "left")
            .select("threshold", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_below")))


@query("multi_agg", sql="""
SELECT l_returnflag, l_linestatus, max(l_quantity) AS l_quantity_max, min(l_quantity) AS l_quantity_min,
       round(avg(l_extendedprice), 6) AS l_extendedprice_mean, max(l_discount) AS l_discount_max,
       min(l_discount) AS l_discount_min, round(avg(l_tax), 6) AS l_tax_mean
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def multi_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several functions per column with flattened ``col_fn`` names."""
    spec = {"l_quantity": ["max", "min"], "l_extendedprice": ["mean"], "l_discount": ["max", "min"],
            "l_tax": ["mean"]}
    fns = {"max": F.max, "min": F.min, "mean": lambda c: r6(F.avg(c))}
    aggs = [fns[f](c).alias(f"{c}_{f}") for c, fs in spec.items() for f in fs]
    return read_table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*aggs)


@query("moments_corr", sql="""
WITH m AS (SELECT l_returnflag, avg(l_extendedprice) AS mu FROM lineitem GROUP BY l_returnflag),
c AS (SELECT l.l_returnflag, avg(power(l_extendedprice - mu, 2)) AS m2, avg(power(l_extendedprice - mu, 3)) AS m3,
             avg(power(l_extendedprice - mu, 4)) AS m4, corr(l_quantity, l_extendedprice) AS r
      FROM lineitem l JOIN m ON l.l_returnflag = m.l_returnflag GROUP BY l.l_returnflag)
SELECT l_returnflag, round(m3 / power(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis,
       round(r, 6) AS corr_qty_price FROM c""")
def moments_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population skewness, excess kurtosis and Pearson
    correlation per group."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(
        r6(F.skewness("l_extendedprice")).alias("skewness"), r6(F.kurtosis("l_extendedprice")).alias("kurtosis"),
        r6(F.corr("l_quantity", "l_extendedprice")).alias("corr_qty_price"))


# --------------------------------------------------------------------------
# missingness on the cohort panel
# --------------------------------------------------------------------------

def _cp(spark, sf_dir) -> DataFrame:
    return C.cohort_panel(spark, sf_dir)


@query("missing_stats", sql=f"""
WITH {cohort_ctes()}
{" UNION ALL ".join(f"SELECT '{c}' AS variable, CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT) AS n_missing, round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 1) AS pct_missing FROM cp" for c in D)}
UNION ALL SELECT 'all', CAST(sum(CAST(total_missing AS BIGINT)) AS BIGINT), round(avg(total_missing) / {len(D)} * 100, 1) FROM cp""")
def missing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K2: missing count and share per variable plus the global share."""
    cp = _cp(spark, sf_dir)
    rows = [F.struct(F.lit(c).alias("variable"), F.sum(F.col(c).isNull().cast("bigint")).alias("n_missing"),
                     F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 1).alias("pct_missing")) for c in D]
    rows.append(F.struct(F.lit("all").alias("variable"), F.sum(F.col("total_missing").cast("bigint")).alias("n_missing"),
                         F.round(F.avg("total_missing") / len(D) * 100, 1).alias("pct_missing")))
    return cp.agg(F.array(*rows).alias("_a")).select(F.inline("_a"))


@query("missing_by_hour", sql=f"""
WITH {cohort_ctes()}
SELECT day, {", ".join(f"round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 6) AS pct_{c}" for c in D)},
       round(avg(total_missing) / {len(D)} * 100, 6) AS pct_total
FROM cp GROUP BY day""")
def missing_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: missing share per bin and variable, and overall per bin."""
    cp = _cp(spark, sf_dir)
    return cp.groupBy("day").agg(*[r6(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"pct_{c}") for c in D],
                                 r6(F.avg("total_missing") / len(D) * 100).alias("pct_total"))


@query("co_missing", sql=f"""
WITH {cohort_ctes()}
{" UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(sum(CAST({a} IS NULL AND {b} IS NULL AS DOUBLE)) / nullif(sum(CAST({a} IS NULL AS DOUBLE)), 0), 2) AS p_b_given_a FROM cp" for a, b in permutations(D, 2))}""")
def co_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: P(B missing | A missing) for every ordered pair, one pass."""
    cp = _cp(spark, sf_dir)
    rows = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                     F.round(F.try_divide(F.sum((F.col(a).isNull() & F.col(b).isNull()).cast("double")),
                                          F.sum(F.col(a).isNull().cast("double"))), 2).alias("p_b_given_a"))
            for a, b in permutations(D, 2)]
    return cp.agg(F.array(*rows).alias("_a")).select(F.inline("_a"))


@query("null_corr", sql=f"""
WITH {cohort_ctes()}
{" UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr(CAST({a} IS NULL AS DOUBLE), CAST({b} IS NULL AS DOUBLE)), 6) AS r FROM cp" for a, b in combinations(D, 2))}""")
def null_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlation of null indicators (= Spearman on
    binary flags) for every pair, one pass."""
    cp = _cp(spark, sf_dir)
    rows = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                     r6(F.corr(F.col(a).isNull().cast("double"), F.col(b).isNull().cast("double"))).alias("r"))
            for a, b in combinations(D, 2)]
    return cp.agg(F.array(*rows).alias("_a")).select(F.inline("_a"))


@query("entity_flags", sql="""
WITH {dp}
SELECT user_id, bool_or(heart_rate IS NOT NULL) AS any_hr, bool_and(fio2 IS NULL) AS all_fio2_null,
       min(CASE WHEN heart_rate IS NOT NULL THEN day END) AS first_valid_day,
       max(CASE WHEN heart_rate IS NOT NULL THEN day END) AS last_valid_day,
       CAST(sum(CASE WHEN day BETWEEN 0 AND 7 THEN 1 ELSE 0 END) AS BIGINT) AS n_first_week
FROM dp GROUP BY user_id""".replace("{dp}", daily_panel_ctes()))
def entity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8/D9/J15 (E18 is ``long_stay_coverage``): any/all over the entity, first/last valid bin,
    coverage count of the first week."""
    dp = C.daily_panel(spark, sf_dir)
    return dp.groupBy(ENTITY).agg(
        F.bool_or(F.col("heart_rate").isNotNull()).alias("any_hr"),
        F.bool_and(F.col("fio2").isNull()).alias("all_fio2_null"),
        F.min(F.when(F.col("heart_rate").isNotNull(), F.col("day"))).alias("first_valid_day"),
        F.max(F.when(F.col("heart_rate").isNotNull(), F.col("day"))).alias("last_valid_day"),
        F.sum(F.col("day").between(0, 7).cast("bigint")).alias("n_first_week"))
