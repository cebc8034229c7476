"""Feature engineering, splits, encoders and MLlib model helpers.

Only p x p matrices (p = number of columns) ever reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.functions.scalar import r6
from wardflow.operators.masking import DRAW_BITS, digest
from wardflow.operators.ranks import number_rows
from wardflow.operators.stats import array_quantile, attach_row
from wardflow.sources.io import write_scratch

UNB = Window.unboundedPreceding


# --------------------------------------------------------------------------
# ranks and splits
# --------------------------------------------------------------------------

def key_hash(key: Column, seed: int, modulus: int) -> Column:
    """Uniform integer in ``[0, modulus)`` from a digest of the key (any
    type, any size)."""
    return F.floor(digest(key, seed) / F.lit(float(1 << DRAW_BITS)) * F.lit(float(modulus))).cast("long")


def hash_split(key: Column, seed: int = 42, train: int = 70, val: int = 15) -> Column:
    """Entity-level split by hash: all rows of an entity land in one set."""
    h = key_hash(key, seed, 100)
    return F.when(h < train, "train").when(h < train + val, "val").otherwise("test")


def stratified_split(df: DataFrame, key: str, stratum: str, seed: int = 42,
                     fractions: tuple[float, float] = (0.6, 0.8), modulus: int = 1_000_003) -> DataFrame:
    """Exact stratified split: inside each stratum rows are ranked by a key
    hash; rank / stratum size below 0.6 -> train, below 0.8 -> val, else
    test.  Ranks and sizes come from sampled ranges of (stratum, hash)."""
    d = df.withColumn("_h", key_hash(F.col(key), seed, modulus))
    ranked = number_rows(d, [F.col("_h").asc(), F.col(key).asc()], [stratum], "_rank", "_size")
    frac = F.col("_rank") / F.col("_size")
    return ranked.withColumn("split", F.when(frac < fractions[0], "train").when(frac < fractions[1], "val")
                             .otherwise("test")).drop("_h", "_rank", "_size")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold numbers 0..folds-1 that deal every class out evenly: the rank by
    a key hash inside the class, modulo ``folds``."""
    d = df.withColumn("_h", digest(F.col(key), seed))
    ranked = number_rows(d, [F.col("_h").asc(), F.col(key).asc()], [label], "_rank")
    return ranked.withColumn(name, (F.col("_rank") % folds).cast("int")).drop("_h", "_rank")


# --------------------------------------------------------------------------
# scaling and encoding
# --------------------------------------------------------------------------

def standardise_long(df: DataFrame, group: str, value: str, fit_on: Column | None = None) -> DataFrame:
    """``z = (x - mean) / std_pop`` per group (e.g. feature) with statistics
    fitted on the rows selected by ``fit_on`` (default all); a zero std
    divides by 1.  Adds ``z``, ``_mean``, ``_std``."""
    fit = df if fit_on is None else df.filter(fit_on)
    st = fit.groupBy(group).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"))
    st = st.withColumn("_std", F.when((F.col("_sd") == 0) | F.col("_sd").isNull(), F.lit(1.0))
                       .otherwise(F.col("_sd"))).drop("_sd")
    return df.join(st, group, "left").withColumn("z", (F.col(value) - F.col("_mean")) / F.col("_std"))


def inverse_standardise(z: str, mean: str = "_mean", std: str = "_std") -> Column:
    return F.col(z) * F.col(std) + F.col(mean)


def label_encode(df: DataFrame, c: str, name: str) -> DataFrame:
    """Sorted-class ordinal code (0-based).  Classes are the distinct values
    (an aggregate), numbered along sampled ranges, then joined back."""
    classes = df.select(c).distinct().filter(F.col(c).isNotNull())
    return df.join(number_rows(classes, [F.col(c).asc()], None, name), c, "left")


# --------------------------------------------------------------------------
# per-series features
# --------------------------------------------------------------------------

def series_features(df: DataFrame, entity: str, t: str, x: str) -> DataFrame:
    """Statistical and temporal features of each entity's series (one row
    per entity): moments, quantiles, energy, differences, slope, turning
    points, mean crossings, trapezoid area, centroid, lag-1 autocorrelation.
    Neighbour values come from ``lag``/``lead`` windows over the entity."""
    w = Window.partitionBy(entity).orderBy(t)
    d = df.withColumns({"_prev": F.lag(x).over(w), "_next": F.lead(x).over(w),
                        "_m": F.avg(x).over(Window.partitionBy(entity))})
    turn_pos = (F.col("_prev") < F.col(x)) & (F.col(x) > F.col("_next"))
    turn_neg = (F.col("_prev") > F.col(x)) & (F.col(x) < F.col("_next"))
    cross = F.signum(F.col(x) - F.col("_m")) != F.signum(F.col("_prev") - F.col("_m"))
    # bounded per-entity series: quantiles from the sorted values
    q = F.array_sort(F.collect_list(x))
    g = d.groupBy(entity).agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.var_samp(x).alias("var"),
        F.min(x).alias("min"), F.max(x).alias("max"), q.alias("_q"),
        F.sqrt(F.avg(F.col(x) * F.col(x))).alias("rms"), F.sum(F.col(x) * F.col(x)).alias("abs_energy"),
        F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"),
        F.avg(F.abs(F.col(x) - F.col("_prev"))).alias("mean_abs_diff"),
        F.sum(F.abs(F.col(x) - F.col("_prev"))).alias("sum_abs_diff"),
        F.regr_slope(x, t).alias("slope"),
        F.count_if(turn_pos).alias("pos_turning"), F.count_if(turn_neg).alias("neg_turning"),
        F.count_if(cross).alias("mean_crossings"),
        F.sum((F.col(x) + F.col("_prev")) / 2.0).alias("area"),
        F.try_divide(F.sum(F.col(t) * F.col(x)), F.sum(x)).alias("centroid"),
        F.corr(x, "_prev").alias("autocorr_lag1"))
    out = g.withColumns({"median": array_quantile(F.col("_q"), 0.5),
                         "iqr": array_quantile(F.col("_q"), 0.75) - array_quantile(F.col("_q"), 0.25)}).drop("_q")
    return out.select(entity, *[r6(c).alias(c) if c not in ("pos_turning", "neg_turning", "mean_crossings")
                                else F.col(c) for c in out.columns if c != entity])


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise (pairwise-complete) Pearson correlations in one aggregate."""
    rows = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), r6(F.corr(a, b)).alias("r"))
            for i, a in enumerate(cols) for b in cols[i + 1:]]
    return df.agg(F.array(*rows).alias("_a")).select(F.inline("_a"))


def drop_correlated(corr_rows: list[tuple[str, str, float]], cols: list[str], threshold: float) -> list[str]:
    """Greedy: walk the columns in order, drop a column whose |r| with an
    already-kept column exceeds the threshold (p x p work on the driver)."""
    r = {(a, b): v for a, b, v in corr_rows}
    r.update({(b, a): v for a, b, v in corr_rows})
    kept: list[str] = []
    for c in cols:
        if all(abs(r.get((c, k)) or 0.0) <= threshold for k in kept):
            kept.append(c)
    return kept


def select_features(df: DataFrame, cols: list[str], threshold: float, suffixes: tuple[str, ...] = ()) -> list[tuple[str, float, str]]:
    """``(name, variance, decision)`` of every column: ``correlated`` with any
    earlier one beyond ``threshold`` in absolute value, ``constant``, ``suffix``
    (its name ends in one of ``suffixes``) or ``kept``.  One pass gives the
    p x p moment matrix."""
    rows = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
    mean = rows.select(*[F.col("_v")[i].alias(f"c{i}") for i in range(len(cols))]).agg(*[F.avg(f"c{i}") for i in range(len(cols))]).first()
    centred = F.transform("_v", lambda x, i: x - F.get(F.array(*[F.lit(float(m or 0.0)) for m in mean]), i))
    cells = rows.select(centred.alias("x")).select(F.posexplode("x").alias("i", "a"), "x").select("i", "a", F.posexplode("x").alias("j", "b")).filter("i <= j")
    s = np.zeros((len(cols), len(cols)))
    n = 0
    for r in cells.groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("s"), F.count(F.lit(1)).alias("n")).collect():     # p (p + 1) / 2 rows
        s[r["i"], r["j"]] = s[r["j"], r["i"]] = r["s"]
        n = r["n"]
    var = np.diag(s) / max(n, 1)
    out = []
    for j, c in enumerate(cols):
        near = any(s[i, i] > 0 and s[j, j] > 0 and abs(s[i, j]) > threshold * np.sqrt(s[i, i] * s[j, j]) for i in range(j))
        decision = "correlated" if near else "constant" if not var[j] > 0 else "suffix" if c.endswith(suffixes) and suffixes else "kept"
        out.append((c, float(var[j]), decision))
    return out


def vif(df: DataFrame, cols: list[str]) -> list[tuple[str, float]]:
    """Uncentred variance inflation factors ``S_jj * (S^-1)_jj`` where S is
    the second-moment matrix, from ONE aggregate of p(p+1)/2 sums."""
    sums = [F.avg(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(cols)
            for j, b in enumerate(cols) if j >= i]
    row = df.na.drop(subset=cols).agg(*sums).first()
    p = len(cols)
    s = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            s[i, j] = s[j, i] = row[f"{i}_{j}"]
    inv = np.linalg.inv(s)
    return [(c, float(s[k, k] * inv[k, k])) for k, c in enumerate(cols)]


# --------------------------------------------------------------------------
# classifiers and unsupervised models
# --------------------------------------------------------------------------

def balanced_weights(df: DataFrame, label: str, name: str = "w") -> DataFrame:
    """Class weight n / (2 n_c) (the 'balanced' rule), from an aggregate."""
    cnt = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = df.agg(F.count(F.lit(1)).alias("_n"))
    w = attach_row(cnt, tot).select(label, (F.col("_n") / (F.lit(2.0) * F.col("_nc"))).alias(name))
    return df.join(F.broadcast(w), label)          # one row per class


#: a training task has at most so many rows, and at least so many where that leaves a core without one
MAX_TASK_ROWS, MIN_TASK_ROWS = 50_000, 5_000


def spread(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written once as a table and dealt by ``key`` over the cores, or
    over more tasks if there are more rows.  A small table that many fits
    read would otherwise stay in the one or two partitions that its last
    shuffle was coalesced to, and every tree would be grown by one task."""
    n = df.count()
    parts = max(1, n // MAX_TASK_ROWS, min(df.sparkSession.sparkContext.defaultParallelism, n // MIN_TASK_ROWS))
    return write_scratch(df.repartition(parts, key), name)


#: grids of the classifiers; ``C`` is the inverse of the summed penalty, as usual for logistic regression
GRIDS = {
    "logreg": {"C": [0.01, 0.1, 1.0, 10.0]},
    "forest": {"numTrees": [100, 200], "maxDepth": [5, 10]},
    "gbt": {"maxIter": [100, 200], "maxDepth": [3, 6]},
}
#: boosting fits its trees one after another, each several Spark jobs, so that the grid above takes hours on a small table; this one is the default
SHORT_GBT = {"maxIter": [10, 20], "maxDepth": [3, 6]}


def fit_classifier(df: DataFrame, kind: str, label: str = "y", cat_cols: list[str] = (), num_cols: list[str] = (), weight: str = "w",
                   fold_col: str = "fold", seed: int = 42, grid: dict[str, list] | None = None):
    """Pipeline (index + one-hot categorical, assemble, scale) and a
    classifier tuned by 5-fold cross-validation on ROC AUC over ``grid``
    (``GRIDS``, for boosting ``SHORT_GBT``), refitted on all rows.  Folds come
    from ``fold_col``, see :func:`stratified_folds`."""
    stages = []
    enc_cols = []
    for c in cat_cols:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh")]
        enc_cols.append(f"{c}_oh")
    stages += [VectorAssembler(inputCols=[*num_cols, *enc_cols], outputCol="_raw"),
               StandardScaler(inputCol="_raw", outputCol="features", withMean=False)]
    clf = {"logreg": lambda: LogisticRegression(labelCol=label, weightCol=weight, maxIter=100),
           "forest": lambda: RandomForestClassifier(labelCol=label, weightCol=weight, seed=seed),
           "gbt": lambda: GBTClassifier(labelCol=label, weightCol=weight, seed=seed)}[kind]()
    chosen = dict(grid or (SHORT_GBT if kind == "gbt" else GRIDS[kind]))
    if "C" in chosen:
        n = df.count()
        chosen["regParam"] = [1.0 / (c * n) for c in chosen.pop("C")]
    builder = ParamGridBuilder()
    for name, values in chosen.items():
        builder = builder.addGrid(clf.getParam(name), values)
    cv = CrossValidator(estimator=Pipeline(stages=[*stages, clf]), estimatorParamMaps=builder.build(), foldCol=fold_col, numFolds=5, seed=seed,
                        parallelism=4, evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"))
    return cv.fit(df)


def positive_probability(pred: DataFrame) -> Column:
    return vector_to_array("probability")[1]


def pca_scores(df: DataFrame, vec_array: str, k: int) -> DataFrame:
    d = df.withColumn("_v", array_to_vector(F.col(vec_array).cast("array<double>")))
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(d)
    out = model.transform(d).withColumn("_pc", vector_to_array("_pc"))
    return out.select("*", *[r6(F.col("_pc")[i]).alias(f"pc{i + 1}") for i in range(k)]).drop("_v", "_pc")


def kmeans_sweep(df: DataFrame, vec_array: str, ks: list[int], silhouette_to: int = 5, seed: int = 42) -> list[tuple[int, float | None, float]]:
    """k-means for each k: (k, silhouette up to ``silhouette_to``,
    within-cluster cost).  The vectors are written once."""
    d = write_scratch(df.select(F.col(vec_array).cast("array<double>").alias("_v")), "vectors").select(array_to_vector("_v").alias("features"))
    out = []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol="features").fit(d)
        sil = ClusteringEvaluator(featuresCol="features").evaluate(model.transform(d)) if k <= silhouette_to else None
        out.append((k, sil, float(model.summary.trainingCost)))
    return out
