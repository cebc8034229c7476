"""Statistics operators: ranking, classifier metrics, calibration,
agreement, regression intervals, profiles and cohort tables.

Global orderings (ROC/PR curves, quantiles) are computed over *distinct order
values* first (an aggregation), so the ordered pass only sees one row per
distinct value; it runs along sampled ranges (:mod:`wardflow.operators.ranks`),
so no task ever receives a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.dictionary import literal_table
from wardflow.functions.scalar import r6, t_quantile_975
from wardflow.operators.ranks import running, running_sums

def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (an aggregate without
    grouping keys) to every row as ONE scalar subquery: evaluated once,
    inlined as a literal -- no join of any kind."""
    sc = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumns({c: sc[c] for c in one_row.columns})


def array_quantile(sorted_arr: Column, q: float) -> Column:
    """Interpolated quantile of an ascending array without nulls (position
    ``(n - 1) q``; ``lo + (hi - lo) * d``, the same arithmetic as
    :func:`exact_quantiles`).  For bounded per-entity arrays."""
    n = F.size(sorted_arr)
    h = (n - 1) * F.lit(q)
    lo = F.element_at(sorted_arr, (F.floor(h) + 1).cast("int"))
    hi = F.element_at(sorted_arr, (F.ceil(h) + 1).cast("int"))
    return F.when(n > 0, lo + (hi - lo) * (h - F.floor(h)))


def auc_by_group(df: DataFrame, group: list[str], score: str, label: str) -> DataFrame:
    """Tie-corrected ROC AUC (Mann-Whitney) per group:
    ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)``; null when a group
    lacks either class.  Counts are aggregated per distinct score, then
    summed along sampled ranges of the scores."""
    per = df.groupBy(*group, score).agg(F.sum(F.col(label)).alias("_pos"),
                                        F.sum(F.lit(1) - F.col(label)).alias("_neg"))
    per = running_sums(per, [F.col(score).asc()], ["_neg"], group)
    per = per.withColumn("_below", F.col("cum__neg") - F.col("_neg"))
    g = per.groupBy(*group).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("_u") / (F.col("n_pos") * F.col("n_neg")))
    return g.select(*group, "n_pos", "n_neg", r6(auc).alias("auc"))


def roc_curve(df: DataFrame, group: list[str], score: str, label: str) -> DataFrame:
    """``group, threshold, fpr, tpr``: the ROC curve of every group from
    counts per distinct score.  A point is kept where the curve turns (the
    step to the next lower score has another slope) and at the end; the origin
    has no threshold.  A rate without its class is null."""
    per = df.groupBy(*group, score).agg(F.sum(F.col(label)).cast("long").alias("_pos"), F.sum(F.lit(1) - F.col(label)).cast("long").alias("_neg"))
    per = per.withColumn("_step", F.struct("_pos", "_neg"))
    c = running(per, [F.col(score).asc()], {"_cp": ("sum", "_pos"), "_cn": ("sum", "_neg"), "_lower": ("lag", "_step")}, group)
    n = c.groupBy(*group).agg(F.max("_cp").alias("_p"), F.max("_cn").alias("_n"))                     # one row per group
    n = n.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_p", "_n")
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    low = F.col("_lower")
    turns = low.isNull() | (low["_pos"] * F.col("_neg") != F.col("_pos") * low["_neg"])
    points = c.filter(turns).join(n, same).select(
        *group, r6(score).alias("threshold"), r6(F.try_divide(F.col("_n") - F.col("_cn") + F.col("_neg"), F.col("_n"))).alias("fpr"),
        r6(F.try_divide(F.col("_p") - F.col("_cp") + F.col("_pos"), F.col("_p"))).alias("tpr"))
    origin = n.select(*[F.col(f"_g_{g}").alias(g) for g in group], F.lit(None).cast("double").alias("threshold"),
                      F.when(F.col("_n") > 0, 0.0).alias("fpr"), F.when(F.col("_p") > 0, 0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision/recall/F2 at every distinct threshold s (positive =
    ``score >= s``), from per-score counts summed along sampled ranges of the
    descending scores."""
    per = df.groupBy(score).agg(F.sum(F.col(label)).alias("_pos"),
                                F.sum(F.lit(1) - F.col(label)).alias("_neg"))
    c = running_sums(per, [F.col(score).desc()], ["_pos", "_neg"])
    tot = per.agg(F.sum("_pos").alias("_P"))
    c = attach_row(c.withColumnsRenamed({"cum__pos": "_tp", "cum__neg": "_fp"}), tot)
    p = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    r = F.col("_tp") / F.col("_P")
    c = c.withColumns({"precision": p, "recall": r})
    f2 = F.try_divide(5 * F.col("precision") * F.col("recall"), 4 * F.col("precision") + F.col("recall"))
    return c.select(F.col(score).alias("threshold"), "precision", "recall", f2.alias("f2"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Row with the largest F2; ties -> lowest threshold."""
    best = F.max_by(F.struct("threshold", "precision", "recall", "f2"),
                    F.struct(F.coalesce("f2", F.lit(-1.0)), -F.col("threshold")))
    b = curve.agg(best.alias("b"))
    return b.select(*[r6(F.col("b")[c]).alias(c) for c in ["threshold", "precision", "recall", "f2"]])


def exact_quantiles(df: DataFrame, x: str, qs: list[float], group: list[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles (position ``(N - 1) q``, the
    rule of ``percentile`` / ``quantile_cont``): one row per ``group`` with
    an array column ``q``.  Counts per distinct value are summed along sampled
    ranges of (group, value), then one conditional aggregate picks the order
    statistics around every target rank -- no task ever holds a whole column
    or group, however the values are spread."""
    group = group or []
    counts = df.filter(F.col(x).isNotNull()).groupBy(*group, x).agg(F.count(F.lit(1)).alias("_n"))
    c = running_sums(counts, [F.col(x).asc()], ["_n"], group).withColumn("_lo", F.col("cum__n") - F.col("_n"))
    n = c.groupBy(*group).agg(F.max("cum__n").alias("_total"))
    if group:                                            # one row per group
        n = n.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_total")
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        c = c.join(n, same).drop(*[f"_g_{g}" for g in group])
    else:
        c = attach_row(c, n)
    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("_total") - 1) * F.lit(q)
        k0, k1 = F.floor(h), F.ceil(h)
        hit0 = (F.col("_lo") <= k0) & (k0 < F.col("cum__n"))
        hit1 = (F.col("_lo") <= k1) & (k1 < F.col("cum__n"))
        aggs += [F.max(F.when(hit0, F.col(x))).alias(f"_v0_{i}"), F.max(F.when(hit1, F.col(x))).alias(f"_v1_{i}"),
                 F.max(h - k0).alias(f"_f_{i}")]
    row = c.groupBy(*group).agg(*aggs)
    vals = [F.col(f"_v0_{i}") + F.col(f"_f_{i}") * (F.col(f"_v1_{i}") - F.col(f"_v0_{i}")) for i in range(len(qs))]
    return row.select(*group, F.array(*vals).alias("q"))


def quantile_bin(df: DataFrame, x: str, n_bins: int, name: str = "bin") -> DataFrame:
    """Equal-frequency bins: edges = interpolated quantiles k/n; bin = number
    of distinct inner edges strictly below x (first bin includes the
    minimum, bins are right-closed); null x -> null bin."""
    qs = [k / n_bins for k in range(1, n_bins)]
    edges = exact_quantiles(df, x, qs).select(F.col("q").alias("_edges"))
    d = attach_row(df, edges)
    b = F.when(F.col(x).isNotNull(),
               F.size(F.filter(F.array_distinct("_edges"), lambda e: e < F.col(x))))
    return d.withColumn(name, b).drop("_edges")


def calibration(df: DataFrame, group: list[str], bin_col: str, score: str, label: str) -> DataFrame:
    return df.groupBy(*group, bin_col).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(label)).alias("observed"),
        r6(F.avg(score)).alias("predicted"))


def confusion(df: DataFrame, label: str | Column, pred: str | Column) -> DataFrame:
    """Complete 2x2 grid of counts (empty cells = 0)."""
    lab = F.col(label) if isinstance(label, str) else label
    prd = F.col(pred) if isinstance(pred, str) else pred
    counts = df.groupBy(lab.cast("int").alias("label"), prd.cast("int").alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    grid = literal_table(counts.sparkSession, [(a, b) for a in (0, 1) for b in (0, 1)], "label int, pred int")
    return (grid.join(counts, ["label", "pred"], "left")
            .select("label", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def bland_altman(df: DataFrame, group: list[str], a: str, b: str, ddof: int = 1) -> DataFrame:
    """Bias (mean of b - a), SD and 95 % limits of agreement."""
    d = F.col(b) - F.col(a)
    sd = F.stddev_samp(d) if ddof == 1 else F.stddev_pop(d)
    g = df.groupBy(*group).agg(F.count(d).alias("n"), F.avg(d).alias("_bias"), sd.alias("_sd"))
    return g.select(*group, "n", r6("_bias").alias("bias"), r6("_sd").alias("sd"),
                    r6(F.col("_bias") - 1.96 * F.col("_sd")).alias("loa_low"),
                    r6(F.col("_bias") + 1.96 * F.col("_sd")).alias("loa_high"))


def regression_ci(df: DataFrame, group: list[str], y: str, x: str) -> DataFrame:
    """OLS of y on x with standard errors and 95 % intervals (t quantile with
    n - 2 degrees of freedom), from one pass of ``regr_*`` aggregates."""
    g = df.groupBy(*group).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("_b1"),
        F.regr_intercept(y, x).alias("_b0"), F.regr_sxx(y, x).alias("_sxx"),
        F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"), F.regr_avgx(y, x).alias("_mx"))
    s2 = (F.col("_syy") - F.col("_b1") * F.col("_sxy")) / (F.col("n") - 2)
    se1 = F.sqrt(s2 / F.col("_sxx"))
    se0 = F.sqrt(s2 * (F.lit(1.0) / F.col("n") + F.col("_mx") * F.col("_mx") / F.col("_sxx")))
    t = t_quantile_975(F.col("n") - 2)
    return g.select(*group, "n", r6("_b1").alias("slope"), r6("_b0").alias("intercept"),
                    r6(se1).alias("se_slope"), r6(se0).alias("se_intercept"),
                    r6(F.col("_b1") - t * se1).alias("slope_lo"), r6(F.col("_b1") + t * se1).alias("slope_hi"),
                    r6(F.col("_b0") - t * se0).alias("intercept_lo"),
                    r6(F.col("_b0") + t * se0).alias("intercept_hi"))


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe()-style profile, one row per column: count, null count,
    mean, sample std, min and max in ONE aggregation; exact interpolated
    quartiles for all columns at once from the unpivoted values
    (:func:`exact_quantiles` grouped by column)."""
    aggs = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("count"),
                     F.count_if(F.col(c).isNull()).alias("null_count"), r6(F.avg(c)).alias("mean"),
                     r6(F.stddev_samp(c)).alias("std"), F.min(c).cast("double").alias("min"),
                     F.max(c).cast("double").alias("max")) for c in cols]
    basic = df.agg(F.array(*aggs).alias("_a")).select(F.inline("_a"))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "_v")
    qs = exact_quantiles(long, "_v", [0.25, 0.5, 0.75], group=["column_name"])
    out = basic.join(qs, "column_name", "left")
    return out.select("column_name", "count", "null_count", "mean", "std", "min",
                      *[r6(F.col("q")[i]).alias(n) for i, n in enumerate(["p25", "p50", "p75"])], "max")


def multi_agg(df: DataFrame, keys: list[str], spec: dict[str, list[str]]) -> DataFrame:
    """Several functions (``max``, ``min``, ``mean``) per column, flattened to
    ``column_function``."""
    fns = {"max": F.max, "min": F.min, "mean": lambda c: r6(F.avg(c))}
    return df.groupBy(*keys).agg(*[fns[f](c).alias(f"{c}_{f}") for c, fs in spec.items() for f in fs])


def table_one(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """Cohort table in one pass over the categories and one over the numbers:
    ``(variable, level, n, pct, mean, sd)``; shares are of the rows with a
    value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([], categorical, "variable", "level").filter("level IS NOT NULL")
    n = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    total = long.groupBy("variable").agg(F.count(F.lit(1)).alias("_n"))
    cat = n.join(F.broadcast(total), "variable").select("variable", "level", "n", F.round(F.col("n") * 100.0 / F.col("_n"), 1).alias("pct"))  # a row per variable
    rows = [F.struct(F.lit(c).alias("variable"), F.count(c).alias("n"), r6(F.avg(c)).alias("mean"), r6(F.stddev_samp(c)).alias("sd")) for c in numeric]
    num = df.agg(F.array(*rows).alias("_a")).select(F.inline("_a")).withColumn("level", F.lit(None).cast("string"))
    return cat.unionByName(num, allowMissingColumns=True).select("variable", "level", "n", "pct", "mean", "sd")
