"""Splits, encoders, series features, samples/slices and MLlib queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.dictionary import literal_table
from wardflow.functions.scalar import r6
from wardflow.operators import imputers as I
from wardflow.operators import models as MD
from wardflow.operators import sequence as S
from wardflow.operators import series as SE
from wardflow.operators import stats as ST
from wardflow.operators.masking import DRAW_BITS, digest_sql
from wardflow.operators.ranks import number_rows
from wardflow.plans import common as C
from wardflow.plans.q_stats import SCORED_CTE, scored
from wardflow.plans.registry import query
from wardflow.plans.sql_common import cohort_ctes, daily_panel_ctes, fill_ctes
from wardflow.sources.io import write_scratch
from wardflow.sources.tables import ENTITY, read_table

D = C.DAILY_COLS


def _key_hash_sql(key: str, seed: int, modulus: int) -> str:
    return f"CAST(floor({digest_sql(key, str(seed))} / {float(1 << DRAW_BITS)} * CAST({modulus} AS DOUBLE)) AS BIGINT)"


def _split_sql(key: str) -> str:
    h = _key_hash_sql(key, 42, 100)
    return f"CASE WHEN {h} < 70 THEN 'train' WHEN {h} < 85 THEN 'val' ELSE 'test' END"


@query("patient_split", sql=f"""
SELECT user_id, {_split_sql("user_id")} AS split FROM (SELECT DISTINCT user_id FROM events)""")
def patient_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-level 70/15/15 split by key hash."""
    u = read_table(spark, sf_dir, "events").select(ENTITY).distinct()
    return u.select(ENTITY, MD.hash_split(F.col(ENTITY)).alias("split"))


@query("stratified_split", sql=f"""
WITH {SCORED_CTE},
r AS (SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY {_key_hash_sql("doc_id", 42, 1000003)}, doc_id) AS rk,
             count(*) OVER (PARTITION BY y) AS n FROM sc)
SELECT doc_id, y, CASE WHEN (rk - 1) / n < 0.6 THEN 'train' WHEN (rk - 1) / n < 0.8 THEN 'val' ELSE 'test' END AS split
FROM r""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact stratified 60/20/20 split by outcome (hash rank within the
    stratum, chunked so a stratum never sits in one task)."""
    s = scored(spark, sf_dir).select("doc_id", "y")
    return MD.stratified_split(s, "doc_id", "y")


@query("standardise", sql=f"""
WITH {cohort_ctes()},
cl AS ({" UNION ALL ".join(f"SELECT user_id, day, '{c}' AS feature, {c} AS x FROM cp" for c in D)}),
st AS (SELECT feature, avg(x) AS m, CASE WHEN stddev_pop(x) = 0 OR stddev_pop(x) IS NULL THEN 1.0 ELSE stddev_pop(x) END AS s
       FROM cl WHERE {_key_hash_sql("user_id", 42, 100)} < 70 GROUP BY feature)
SELECT cl.user_id, cl.day, cl.feature, round((x - m) / s, 6) AS z, round((x - m) / s * s + m, 6) AS x_back
FROM cl JOIN st ON cl.feature = st.feature""")
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-feature z-scores (population std, constant -> 1)
    fitted on the training entities only, and the inverse transform."""
    long = C.cohort_long(spark, sf_dir).withColumnRenamed("original", "x")
    train = MD.key_hash(F.col(ENTITY), 42, 100) < 70
    z = MD.standardise_long(long, "feature", "x", fit_on=train)
    return z.select(ENTITY, "day", "feature", r6("z").alias("z"), r6(MD.inverse_standardise("z")).alias("x_back"))


@query("label_encode", sql="""
SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: alphabetical ordinal codes of a categorical column."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return MD.label_encode(c, "c_mktsegment", "code").withColumn("code", F.col("code").cast("bigint"))


@query("early_late_slices", sql=f"""
WITH {daily_panel_ctes()},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS ra,
             row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rd FROM dp)
SELECT user_id, day, 'early' AS slice, heart_rate FROM r WHERE ra <= 3
UNION ALL SELECT user_id, day, 'late', heart_rate FROM r WHERE rd <= 3""")
def early_late_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last N bins of every entity."""
    dp = C.daily_panel(spark, sf_dir)
    w = Window.partitionBy(ENTITY)
    r = dp.withColumns({"_ra": F.row_number().over(w.orderBy("day")),
                        "_rd": F.row_number().over(w.orderBy(F.col("day").desc()))})
    early = r.filter(F.col("_ra") <= 3).select(ENTITY, "day", F.lit("early").alias("slice"), "heart_rate")
    late = r.filter(F.col("_rd") <= 3).select(ENTITY, "day", F.lit("late").alias("slice"), "heart_rate")
    return early.unionByName(late)


@query("sample_rows", sql=f"""
SELECT o_orderkey, o_custkey, {_key_hash_sql("o_orderkey", 42, 1000003)} AS h FROM orders
ORDER BY h, o_orderkey LIMIT 100""")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 (F5 and F6 are ``draw_with_replacement`` and ``single_entity``): reproducible sample of 100 rows (smallest key hashes); a
    top-k per partition then a merge, never a full sort in one task."""
    o = read_table(spark, sf_dir, "orders")
    h = MD.key_hash(F.col("o_orderkey"), 42, 1_000_003)
    return o.select("o_orderkey", "o_custkey", h.alias("h")).orderBy("h", "o_orderkey").limit(100)


@query("row_index", sql=f"""
WITH {daily_panel_ctes()},
f AS (SELECT user_id, max(CASE WHEN heart_rate IS NOT NULL THEN day END) AS last_valid_day FROM dp GROUP BY user_id)
SELECT user_id, last_valid_day, row_number() OVER (ORDER BY last_valid_day DESC NULLS LAST, user_id) AS row_index
FROM f""")
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive row index over a sort order (last valid bin desc,
    id), counted along sampled ranges instead of a single-partition window."""
    dp = C.daily_panel(spark, sf_dir)
    f = dp.groupBy(ENTITY).agg(F.max(F.when(F.col("heart_rate").isNotNull(), F.col("day"))).alias("last_valid_day"))
    out = number_rows(f, [F.col("last_valid_day").desc_nulls_last(), F.col(ENTITY).asc()], None, "row_index")
    return out.withColumn("row_index", F.col("row_index") + 1)


def _series_sql() -> str:
    return f"""WITH {cohort_ctes()},
x0 AS (SELECT user_id, day, heart_rate AS v FROM cp),
x1 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM x0),
x2 AS (SELECT *,
  last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni
  FROM x1),
x AS (SELECT user_id, day, CASE WHEN v IS NOT NULL THEN v ELSE coalesce(pv + (nv - pv) * (CAST(i - pi AS DOUBLE) / (ni - pi)), pv, nv) END AS x
      FROM x2),
y AS (SELECT *, lag(x) OVER (PARTITION BY user_id ORDER BY day) AS prv, lead(x) OVER (PARTITION BY user_id ORDER BY day) AS nxt,
             avg(x) OVER (PARTITION BY user_id) AS m FROM x),
g AS (SELECT user_id, avg(x) AS mean, stddev_samp(x) AS std, var_samp(x) AS var, min(x) AS min, max(x) AS max,
        quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr,
        sqrt(avg(x * x)) AS rms, sum(x * x) AS abs_energy,
        avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5) AS skewness,
        avg(power(x - m, 4)) / power(avg(power(x - m, 2)), 2) - 3 AS kurtosis,
        avg(abs(x - prv)) AS mean_abs_diff, sum(abs(x - prv)) AS sum_abs_diff, regr_slope(x, day) AS slope,
        count(CASE WHEN prv < x AND x > nxt THEN 1 END) AS pos_turning,
        count(CASE WHEN prv > x AND x < nxt THEN 1 END) AS neg_turning,
        count(CASE WHEN sign(x - m) <> sign(prv - m) THEN 1 END) AS mean_crossings,
        sum((x + prv) / 2.0) AS area, sum(day * x) / nullif(sum(x), 0) AS centroid, corr(x, prv) AS autocorr_lag1
      FROM y GROUP BY user_id)
SELECT user_id, {", ".join(f"round({c}, 6) AS {c}" for c in
    ["mean", "std", "var", "min", "max", "rms", "abs_energy", "skewness", "kurtosis", "mean_abs_diff",
     "sum_abs_diff", "slope", "area", "centroid", "autocorr_lag1", "median", "iqr"])},
  pos_turning, neg_turning, mean_crossings FROM g"""


@query("series_features", sql=_series_sql())
def series_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of L2/L3 (``series_profile`` has all): statistical and temporal features of each entity's
    (interpolated) heart-rate series, grouped by entity (never windows
    spanning two entities)."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", "heart_rate")
    x = S.interpolate(cp, ENTITY, "day", ["heart_rate"], "both")
    return MD.series_features(x, ENTITY, "day", "heart_rate")


@query("corr_matrix", sql=f"""
WITH {cohort_ctes()}
{" UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS r FROM cp"
                    for i, a in enumerate(D) for b in D[i + 1:])}""")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D24, and the matrix step of L4: pairwise Pearson correlation matrix (one aggregate); the
    greedy high-correlation drop works on this p x p result."""
    return MD.corr_matrix(C.cohort_panel(spark, sf_dir), D)


@query("variance_filter", sql="""
SELECT column_name, round(v, 6) AS variance, v > 0 AS keep FROM (
  SELECT 'l_quantity' AS column_name, var_pop(l_quantity) AS v FROM lineitem
  UNION ALL SELECT 'l_discount', var_pop(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', var_pop(l_tax) FROM lineitem
  UNION ALL SELECT 'const_one', var_pop(1.0) FROM lineitem)""")
def variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-variance filter of L5, without its suffix rule (population variance > 0)."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("const_one", F.lit(1.0))
    cols = ["l_quantity", "l_discount", "l_tax", "const_one"]
    rows = [F.struct(F.lit(c).alias("column_name"), F.var_pop(c).alias("v")) for c in cols]
    x = li.agg(F.array(*rows).alias("_a")).select(F.inline("_a"))
    return x.select("column_name", r6("v").alias("variance"), (F.col("v") > 0).alias("keep"))


VIF_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _det_sql(rows: list[int], cols: list[int]) -> str:
    """Determinant of a block of the moment matrix, by cofactors."""
    if not rows:
        return "1.0"
    parts = []
    for j, c in enumerate(cols):
        cell = f"s{min(rows[0], c)}_{max(rows[0], c)}"
        parts.append(("-" if j % 2 else "+") + f" {cell} * ({_det_sql(rows[1:], cols[:j] + cols[j + 1:])})")
    return " ".join(parts).lstrip("+ ")


def _vif_sql() -> str:
    p = range(len(VIF_COLS))
    sums = ", ".join(f"avg({VIF_COLS[i]} * {VIF_COLS[j]}) AS s{i}_{j}" for i in p for j in p if j >= i)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS column_name, s{k}_{k} * ({_det_sql([i for i in p if i != k], [i for i in p if i != k])}) / "
                              f"({_det_sql(list(p), list(p))}) AS v FROM m" for k, c in enumerate(VIF_COLS))
    return f"WITH m AS (SELECT {sums} FROM lineitem), r AS ({rows}) SELECT column_name, round(v, 6) AS vif, v < 10 AS keep FROM r"


@query("vif", sql=_vif_sql())
def vif_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncentred variance inflation factors of lineitem numeric columns
    (p x p moment matrix from one aggregate, inverted on the driver)."""
    v = MD.vif(read_table(spark, sf_dir, "lineitem"), VIF_COLS)
    return literal_table(spark, [(c, round(x, 6), x < 10) for c, x in v],
                         "column_name string, vif double, keep boolean")


@query("mice_regression")
def mice_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained regressions fitted on the training entities (30 rounds at
    most), applied to the whole cohort panel."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    model = I.ChainedLinear(D, max_rounds=30).fit(cp.filter(MD.hash_split(F.col(ENTITY)) == "train"))
    out = model.transform(cp)
    return out.select(ENTITY, "day", *[r6(c).alias(c) for c in D])


@query("forest_impute")
def forest_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained random forests fitted on the training entities until the
    change grows (10 rounds at most), applied to the whole cohort panel."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D)
    out = I.ChainedForest(D).fit(cp.filter(MD.hash_split(F.col(ENTITY)) == "train")).transform(cp)
    return out.select(ENTITY, "day", *[r6(c).alias(c) for c in D])


def _doc_features(spark, sf_dir) -> DataFrame:
    """Numbers of every labelled document; they are taken before the join, so
    that no text is shuffled."""
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang",
        F.log1p(F.length("text")).alias("log_len"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.try_divide(F.length(F.regexp_replace("text", "[^A-Z]", "")), F.length("text")).alias("upper_share"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    x = d.join(lab, "doc_id").select("doc_id", "y", "lang", "log_len", "n_words", "n_lines", "upper_share")
    return x.na.fill({"upper_share": 0.0})


def split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their split, and the training rows with weights and
    folds, each written once and dealt over the cluster: every fold and grid
    point reads them, and the texts are read once."""
    x = write_scratch(_doc_features(spark, sf_dir), "features")
    x = MD.spread(MD.stratified_split(x, "doc_id", "y"), "doc_id", "split")
    train = MD.stratified_folds(MD.balanced_weights(x.filter("split = 'train'").drop("split"), "y"), "doc_id", "y")
    return x, MD.spread(train, "doc_id", "train")


def held_out(spark: SparkSession, sf_dir: str, kind: str, grid: dict[str, list] | None = None,
             rows: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``(doc_id, y, split, prob, pred)`` of the rows the model has not seen:
    exact stratified 60/20/20 split, class weights and folds (rank modulo 5
    within each class) on the training rows alone, grid search on ROC AUC,
    refit on all training rows.  ``rows``: those of :func:`split_rows`, if
    several models share them."""
    x, train = rows or split_rows(spark, sf_dir)
    model = MD.fit_classifier(train, kind, cat_cols=["lang"], num_cols=["log_len", "n_words", "n_lines", "upper_share"], grid=grid)
    pred = model.transform(x.filter("split <> 'train'").withColumn("w", F.lit(1.0)))
    return pred.select("doc_id", "y", "split", MD.positive_probability(pred).alias("prob"), F.col("prediction").cast("int").alias("pred"))


def _classify(spark, sf_dir, kind) -> DataFrame:
    return held_out(spark, sf_dir, kind).withColumn("prob", r6("prob"))


@query("classify_logreg")
def classify_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced logistic regression, stratified 5-fold CV on ROC AUC
    over C = 0.01..10, predictions on held-out rows."""
    return _classify(spark, sf_dir, "logreg")


@query("classify_forest")
def classify_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced random forest, stratified 5-fold CV over 100/200 trees
    and depth 5/10, predictions on held-out rows."""
    return _classify(spark, sf_dir, "forest")


@query("classify_gbt")
def classify_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of L8/L9: gradient-boosted trees with class weights, stratified
    5-fold CV over depth 3/6 and 10/20 rounds (the full grid of 100/200 rounds
    is ``models.GRIDS``, see there), predictions on held-out rows."""
    return _classify(spark, sf_dir, "gbt")


_HELD_CTES = f"""{SCORED_CTE},
ho AS (SELECT doc_id, y, (row_number() OVER (PARTITION BY y ORDER BY {_key_hash_sql("doc_id", 42, 1000003)}, doc_id) - 1) / count(*) OVER (PARTITION BY y) AS share FROM sc)"""


#: one point of each grid, for what holds of any fitted model
ONE_POINT = {"logreg": {"C": [1.0]}, "forest": {"numTrees": [20], "maxDepth": [5]}, "gbt": {"maxIter": [5], "maxDepth": [3]}}


@query("held_out_rows", sql=f"""WITH {_HELD_CTES}
SELECT kind, CASE WHEN share < 0.8 THEN 'val' ELSE 'test' END AS split, CAST(y AS INTEGER) AS y, count(*) AS n, count(*) AS n_probability, count(*) AS n_consistent
FROM ho, (VALUES ('logreg'), ('forest'), ('gbt')) k(kind) WHERE share >= 0.6 GROUP BY 1, 2, 3""")
def held_out_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every kind of classifier (one grid point each) the rows
    predicted per split and class, those with a probability between 0 and 1,
    and those whose class agrees with it: all rows outside the training set
    and no other."""
    parts, rows = [], split_rows(spark, sf_dir)
    for kind, grid in ONE_POINT.items():
        h = held_out(spark, sf_dir, kind, grid, rows)
        agrees = (F.col("prob") > 0.5).cast("int") == F.col("pred")
        parts.append(h.groupBy("split", F.col("y").cast("int").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("prob").between(0, 1)).alias("n_probability"),
            F.count_if(agrees | (F.col("prob") == 0.5)).alias("n_consistent")).select(F.lit(kind).alias("kind"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("held_out_metrics")
def held_out_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K16-K18/D20 on held-out predictions (logistic regression): per split
    the area under the ROC curve, the best F2 threshold with its precision and
    recall, accuracy at 0.5, and the calibration by uniform fifths."""
    h = write_scratch(held_out(spark, sf_dir, "logreg").withColumn("y", F.col("y").cast("int")), "held_out")
    auc = ST.auc_by_group(h, ["split"], "prob", "y").select("split", F.lit("auc").alias("metric"), F.lit(None).cast("int").alias("bin"), F.col("auc").alias("value"))
    best = [ST.best_threshold(ST.pr_curve(h.filter(F.col("split") == s), "prob", "y")).select(
        F.lit(s).alias("split"), F.inline(F.array(*[F.struct(F.lit(f"f2_{c}" if c != "f2" else c).alias("metric"), F.lit(None).cast("int").alias("bin"), F.col(c).alias("value"))
                                                    for c in ("threshold", "precision", "recall", "f2")]))) for s in ("val", "test")]
    right = h.groupBy("split").agg(r6(F.avg((F.col("y") == F.col("pred")).cast("double"))).alias("value")).select(
        "split", F.lit("accuracy").alias("metric"), F.lit(None).cast("int").alias("bin"), "value")
    fifth = F.least(F.floor(F.col("prob") * 5), F.lit(4)).cast("int")
    cal = ST.calibration(h.withColumn("bin", fifth), ["split"], "bin", "prob", "y").select(
        "split", F.lit("observed").alias("metric"), "bin", F.col("observed").alias("value"))
    out = auc.unionByName(right).unionByName(cal)
    for b in best:
        out = out.unionByName(b)
    return out


@query("pca")
def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three principal components of the embedding vectors."""
    e = read_table(spark, sf_dir, "embeddings")
    return MD.pca_scores(e, "embedding", 3).select("vec_id", "label", "pc1", "pc2", "pc3")


_PROFILE_FILL = fill_ctes("cp", "pf", [(c, "both") for c in D])
_PROFILE_LONG = " UNION ALL ".join(f"SELECT user_id, '{c}' AS feature, day, {c} AS x FROM pf WHERE {c} IS NOT NULL" for c in D)


@query("series_profile", sql=f"""WITH {cohort_ctes()},
{_PROFILE_FILL},
sl AS ({_PROFILE_LONG}),
{SE.profile_sql("sl", "user_id, feature")}
SELECT * FROM sp""")
def series_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3: all statistical and temporal features of the interpolated series
    of all four variables of every cohort entity."""
    return SE.series_profile(feature_series(spark, sf_dir), [ENTITY, "feature"], "series")


@query("pca_invariants", sql="""
SELECT count(*) AS n, TRUE AS ordered, TRUE AS uncorrelated, TRUE AS within_total FROM embeddings""")
def pca_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the component scores of all vectors: variances fall, scores of
    different components are uncorrelated, and no more than the vectors' whole
    variance is in them."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    p = MD.pca_scores(e, "embedding", 3)
    whole = e.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v")).groupBy("i").agg(F.var_pop("v").alias("v")).agg(F.sum("v").alias("v"))
    v = [F.var_pop(f"pc{i}") for i in (1, 2, 3)]
    r = [F.abs(F.corr(f"pc{i}", f"pc{j}")) < 1e-3 for i, j in ((1, 2), (1, 3), (2, 3))]
    return p.agg(F.count(F.lit(1)).alias("n"), ((v[0] >= v[1]) & (v[1] >= v[2])).alias("ordered"), (r[0] & r[1] & r[2]).alias("uncorrelated"),
                 (v[0] + v[1] + v[2] <= whole.select("v").scalar() * 1.000001).alias("within_total"))


@query("cluster_invariants", sql=f"""WITH {cohort_ctes()}
SELECT k, (SELECT count(DISTINCT user_id) FROM cp) AS n_series, k AS n_clusters, TRUE AS nearest, TRUE AS medoid_is_member FROM (VALUES (2), (3), (5)) v(k)""")
def cluster_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of DTW k medoids for several k: every series is in one cluster,
    none is empty, the own medoid is no farther than the next, and each
    cluster has a series at distance 0, its medoid."""
    from wardflow.operators.dtw import dtw_sweep
    out, _ended = dtw_sweep(cohort_series(spark, sf_dir), ENTITY, [2, 3, 5], WARP, max_iter=30)
    c = out.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("dist") <= F.col("second")).alias("near"), F.min("dist").alias("least"))
    return c.groupBy("k").agg(F.sum("n").alias("n_series"), F.count(F.lit(1)).cast("int").alias("n_clusters"), F.bool_and("near").alias("nearest"),
                              F.bool_and(F.col("least") == 0).alias("medoid_is_member"))


def feature_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, feature, series)``: the interpolated cohort series of all
    four variables, as arrays in bin order (bounded by the cohort length)."""
    x = S.interpolate(C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D), ENTITY, "day", D, "both")
    rows = F.array_sort(F.collect_list(F.struct("day", *D)))
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"rows.{c}").alias("series")) for c in D])
    return x.groupBy(ENTITY).agg(rows.alias("rows")).select(ENTITY, F.inline(each))


def cohort_series(spark: SparkSession, sf_dir: str, col: str = "heart_rate") -> DataFrame:
    """One fixed-length (cohort) interpolated series per entity as an array,
    built with a sorted ``collect_list`` of (bin, value) structs -- bounded
    by the cohort length."""
    cp = C.cohort_panel(spark, sf_dir).select(ENTITY, "day", col)
    x = S.interpolate(cp, ENTITY, "day", [col], "both")
    arr = F.array_sort(F.collect_list(F.struct("day", col)))
    return x.groupBy(ENTITY).agg(F.transform(arr, lambda s: s[col]).alias("series"))


SWEEP_K = list(range(2, 20))
SILHOUETTE_K = 5


@query("series_kmeans")
def series_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means over entity series: inertia for k = 2..19 (elbow),
    silhouette for k = 2..5."""
    res = MD.kmeans_sweep(cohort_series(spark, sf_dir), "series", SWEEP_K, SILHOUETTE_K)
    return literal_table(spark, [(k, None if sil is None else round(sil, 6), round(cost, 6)) for k, sil, cost in res],
                         "k int, silhouette double, inertia double")


#: bins that a warping path may leave the diagonal by
WARP = 5


@query("series_dtw_sweep")
def series_dtw_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DTW k medoids: inertia for k = 2..19, silhouette against medoids
    for k = 2..5, iterations, whether they converged, and the share of
    warpings that the envelopes left to do."""
    from wardflow.operators.dtw import dtw_sweep
    out, ended = dtw_sweep(cohort_series(spark, sf_dir), ENTITY, SWEEP_K, WARP)
    sil = F.try_divide(F.col("second") - F.col("dist"), F.greatest("second", "dist"))
    g = out.groupBy("k").agg(r6(F.sum(F.col("dist") * F.col("dist"))).alias("inertia"), r6(F.avg(sil)).alias("silhouette"), r6(F.avg("share")).alias("warped_share"))
    run = literal_table(spark, [(k, n, ok) for k, (n, ok) in ended.items()], "k int, iterations int, converged boolean")
    return g.join(run, "k").select("k", "inertia", F.when(F.col("k") <= SILHOUETTE_K, F.col("silhouette")).alias("silhouette"), "iterations", "converged", "warped_share")


@query("series_dtw_clusters")
def series_dtw_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DTW k-medoids (k = 3) of the entity series: cluster, DTW distance
    to its medoid per entity (sum of squares = inertia), and whether the
    medoids settled."""
    from wardflow.operators.dtw import dtw_kmedoids
    s = cohort_series(spark, sf_dir)
    return dtw_kmedoids(s, ENTITY, 3).select(ENTITY, "cluster", r6("dist").alias("dist"), "converged")
