"""Features of bounded series, one row per series.

A series is an array without nulls (one fixed-length window of an entity).
Everything that depends on neighbouring values comes from one pass of an
array aggregate whose state carries the last values, extrema, sign changes
and sums; what depends on the values' distribution comes from the sorted
array.  No window, no explode and no join: the work per series is its length
times a constant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.scalar import r6
from wardflow.operators.stats import array_quantile

HIST_BINS = 10
#: neighbours on each side that a peak exceeds
NEIGHBOURS = 3

#: sums and counts of the pass over a series; all start at 0
COUNTERS = ("abs_energy", "abs_dev", "m2", "m3", "m4", "moment", "abs_diff", "distance", "area", "energy_time", "pos_turning", "neg_turning",
            "mean_crossings", "zero_crossings")
FEATURES = ("n", "mean", "std", "var", "min", "max", "median", "iqr", "rms", "abs_energy", "average_power", "mean_abs_dev", "median_abs_dev",
            "skewness", "kurtosis", "entropy", "ecdf_p20", "ecdf_p80", "ecdf_n20", "ecdf_n80", "ecdf_slope",
            *[f"hist_{i}" for i in range(HIST_BINS)], "autocorr_lag1", "area", "centroid", "mean_diff", "median_diff", "mean_abs_diff",
            "median_abs_diff", "sum_abs_diff", "distance", "slope", "pos_turning", "neg_turning", "mean_crossings", "zero_crossings",
            "peak_to_peak", "neighbourhood_peaks")


def _total(x: Column, f=lambda v: v) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + f(v))


def _scan(x: Column, mean: Column) -> Column:
    """Struct of ``COUNTERS`` after one pass over ``x``."""
    start = F.struct(F.lit(0).alias("i"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"),
                     *[F.lit(0.0).alias(c) for c in COUNTERS])

    def step(s: Column, v: Column) -> Column:
        first, d, c = s["b"].isNull(), v - s["b"], v - mean
        one = {
            "abs_energy": v * v, "abs_dev": F.abs(c), "m2": c * c, "m3": c * c * c, "m4": c * c * c * c, "moment": s["i"] * v, "energy_time": s["i"] * v * v,
            "abs_diff": F.when(first, 0.0).otherwise(F.abs(d)), "distance": F.when(first, 0.0).otherwise(F.sqrt(F.lit(1.0) + d * d)),
            "area": F.when(first, 0.0).otherwise(F.abs(v + s["b"]) / 2.0),
            "pos_turning": F.when((s["a"] < s["b"]) & (s["b"] > v), 1.0).otherwise(0.0),
            "neg_turning": F.when((s["a"] > s["b"]) & (s["b"] < v), 1.0).otherwise(0.0),
            "mean_crossings": F.when(F.signum(c) != F.signum(s["b"] - mean), 1.0).otherwise(0.0),
            "zero_crossings": F.when(F.signum(v) != F.signum(s["b"]), 1.0).otherwise(0.0),
        }
        return F.struct((s["i"] + 1).alias("i"), s["b"].alias("a"), v.alias("b"), *[(s[k] + one[k]).alias(k) for k in COUNTERS])

    return F.aggregate(x, start, step)


def _equals(i: int):
    return lambda v: v == i


def _differences(x: Column) -> Column:
    return F.transform(F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), lambda v, i: v - F.get(x, i))


def _lag_correlation(x: Column, n: Column) -> Column:
    a, b = F.slice(x, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(x, F.lit(1), F.greatest(n - 1, F.lit(0)))
    ma, mb = _total(a) / (n - 1), _total(b) / (n - 1)
    cross = F.aggregate(F.zip_with(a, b, lambda p, q: (p - ma) * (q - mb)), F.lit(0.0), lambda s, v: s + v)
    va, vb = _total(a, lambda v: (v - ma) * (v - ma)), _total(b, lambda v: (v - mb) * (v - mb))
    return F.when(n > 2, F.try_divide(cross, F.sqrt(va * vb)))


def _peaks(x: Column, n: Column, k: int) -> Column:
    """Values that exceed their ``k`` neighbours on both sides."""
    def peak(v: Column, i: Column) -> Column:
        above = F.lit(True)
        for j in range(1, k + 1):
            above = above & (v > F.get(x, i - j)) & (v > F.get(x, i + j))
        return (i >= k) & (i < n - k) & F.coalesce(above, F.lit(False))
    return F.size(F.filter(x, peak))


def series_profile(df: DataFrame, keys: list[str], series: str) -> DataFrame:
    """``keys`` and ``FEATURES`` of every series with at least one value
    (nulls in it are left out), doubles rounded to 6 places.  Variance,
    skewness and kurtosis are those of the population; the histogram has
    equal bins between minimum and maximum (a constant series is in the
    middle bin); features of differences are null for a single value."""
    d = df.withColumn("x", F.filter(F.col(series), lambda v: v.isNotNull())).filter(F.size("x") > 0)
    x, n = F.col("x"), F.col("n")
    d = d.select(*keys, x, F.size("x").alias("n"), F.array_sort("x").alias("sorted"), _differences(x).alias("diffs"))
    d = d.withColumn("mean", _total(x) / n)
    d = d.withColumns({"scan": _scan(x, F.col("mean")), "min": F.array_min("x"), "max": F.array_max("x"),
                       "median": array_quantile(F.col("sorted"), 0.5)})
    s, srt, dif = F.col("scan"), F.col("sorted"), F.col("diffs")
    var = s["m2"] / n
    low, high, span = F.col("min"), F.col("max"), F.col("max") - F.col("min")
    place = lambda v: F.when(span > 0, F.least(F.floor((v - low) / span * HIST_BINS), F.lit(HIST_BINS - 1))).otherwise(HIST_BINS // 2)
    d = d.withColumn("places", F.transform(x, place))
    shares = F.transform(F.array_distinct("x"), lambda v: F.size(F.filter(x, lambda w: w == v)) / n)
    ecdf = lambda p: F.floor(n * F.lit(p) + F.lit(1e-9)).cast("int")  # noqa: E731  values whose share in order is at most p
    at = lambda p: F.when(ecdf(p) > 0, F.get(srt, ecdf(p) - 1))
    out = {
        "n": n, "mean": F.col("mean"), "std": F.sqrt(var), "var": var, "min": low, "max": high, "median": F.col("median"),
        "iqr": array_quantile(srt, 0.75) - array_quantile(srt, 0.25), "rms": F.sqrt(s["abs_energy"] / n), "abs_energy": s["abs_energy"],
        "average_power": F.when(n > 1, s["abs_energy"] / (n - 1)), "mean_abs_dev": s["abs_dev"] / n,
        "median_abs_dev": array_quantile(F.array_sort(F.transform(x, lambda v: F.abs(v - F.col("median")))), 0.5),
        "skewness": F.when(span > 0, F.try_divide(s["m3"] / n, F.pow(var, 1.5))), "kurtosis": F.when(span > 0, F.try_divide(s["m4"] / n, var * var) - 3),
        "entropy": F.when(n > 1, F.abs(F.aggregate(shares, F.lit(0.0), lambda t, p: t + p * F.log2(p))) / F.log2(n)),
        "ecdf_p20": at(0.2), "ecdf_p80": at(0.8), "ecdf_n20": ecdf(0.2), "ecdf_n80": ecdf(0.8),
        "ecdf_slope": F.try_divide(F.lit(0.25), at(0.75) - at(0.5)),
        **{f"hist_{i}": F.size(F.filter("places", _equals(i))) for i in range(HIST_BINS)},
        "autocorr_lag1": _lag_correlation(x, n), "area": F.when(n > 1, s["area"]), "centroid": F.try_divide(s["energy_time"], s["abs_energy"]),
        "mean_diff": F.try_divide(_total(dif), n - 1), "median_diff": array_quantile(F.array_sort(dif), 0.5),
        "mean_abs_diff": F.try_divide(s["abs_diff"], n - 1), "median_abs_diff": array_quantile(F.array_sort(F.transform(dif, F.abs)), 0.5),
        "sum_abs_diff": F.when(n > 1, s["abs_diff"]), "distance": F.when(n > 1, s["distance"]),
        "slope": F.try_divide(s["moment"] - (n - 1) / 2.0 * n * F.col("mean"), n * (n * n - 1) / 12.0),
        **{c: s[c].cast("int") for c in ("pos_turning", "neg_turning", "mean_crossings", "zero_crossings")},
        "peak_to_peak": span, "neighbourhood_peaks": _peaks(x, n, NEIGHBOURS),
    }
    counts = {"n", "ecdf_n20", "ecdf_n80", "pos_turning", "neg_turning", "mean_crossings", "zero_crossings", "neighbourhood_peaks",
              *[f"hist_{i}" for i in range(HIST_BINS)]}
    return d.select(*keys, *[(out[c].cast("int") if c in counts else r6(out[c])).alias(c) for c in FEATURES])


def profile_sql(source: str, keys: str) -> str:
    """The same features in DuckDB SQL, from ``source`` with ``keys``, the
    time ``day`` and the value ``x`` (no nulls)."""
    hist = ", ".join(f"CAST(count(CASE WHEN b = {i} THEN 1 END) AS INTEGER) AS hist_{i}" for i in range(HIST_BINS))
    peak = " AND ".join(f"x > lag(x, {j}) OVER w AND x > lead(x, {j}) OVER w" for j in range(1, NEIGHBOURS + 1))
    rounded = [c for c in FEATURES if c not in ("n", "ecdf_n20", "ecdf_n80", "pos_turning", "neg_turning", "mean_crossings", "zero_crossings",
                                                "neighbourhood_peaks") and not c.startswith("hist_")]
    whole = [c for c in FEATURES if c not in rounded]
    n20, n50, n75, n80 = (f"CAST(floor(n * {p} + 1e-9) AS INTEGER)" for p in (0.2, 0.5, 0.75, 0.8))
    return f"""sp1 AS (SELECT {keys}, day, x, row_number() OVER (PARTITION BY {keys} ORDER BY day) - 1 AS i, avg(x) OVER (PARTITION BY {keys}) AS m,
  min(x) OVER (PARTITION BY {keys}) AS lo, max(x) OVER (PARTITION BY {keys}) AS hi, median(x) OVER (PARTITION BY {keys}) AS med,
  count(*) OVER (PARTITION BY {keys}, x) AS same, count(*) OVER (PARTITION BY {keys}) AS cnt FROM {source}),
sp2 AS (SELECT *, lag(x) OVER w AS p, lead(x) OVER w AS q, ({peak}) AS peak,
  CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {HIST_BINS}), {HIST_BINS - 1}) ELSE {HIST_BINS // 2} END AS INTEGER) AS b
  FROM sp1 WINDOW w AS (PARTITION BY {keys} ORDER BY day)),
sp3 AS (SELECT {keys}, count(*) AS n, avg(x) AS mean, sqrt(avg((x - m) * (x - m))) AS std, avg((x - m) * (x - m)) AS var, min(x) AS min, max(x) AS max,
  median(x) AS median, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr, sqrt(avg(x * x)) AS rms, sum(x * x) AS abs_energy,
  avg(abs(x - m)) AS mean_abs_dev, median(abs(x - med)) AS median_abs_dev,
  CASE WHEN max(x) > min(x) THEN avg(power(x - m, 3)) / power(avg((x - m) * (x - m)), 1.5) END AS skewness,
  CASE WHEN max(x) > min(x) THEN avg(power(x - m, 4)) / power(avg((x - m) * (x - m)), 2) - 3 END AS kurtosis,
  CASE WHEN count(*) > 1 THEN abs(sum(log2(same / cnt) / cnt)) / log2(count(*)) END AS entropy, list(x ORDER BY x) AS srt, {hist},
  CASE WHEN count(*) > 2 AND stddev_pop(CASE WHEN p IS NOT NULL THEN x END) > 0 AND stddev_pop(p) > 0 THEN corr(x, p) END AS autocorr_lag1,
  sum(abs(x + p) / 2.0) AS area, sum(i * x * x) / nullif(sum(x * x), 0) AS centroid, avg(x - p) AS mean_diff, median(x - p) AS median_diff,
  avg(abs(x - p)) AS mean_abs_diff, median(abs(x - p)) AS median_abs_diff, sum(abs(x - p)) AS sum_abs_diff, sum(sqrt(1 + (x - p) * (x - p))) AS distance,
  CASE WHEN count(*) > 1 THEN regr_slope(x, i) END AS slope, CAST(count(CASE WHEN p < x AND x > q THEN 1 END) AS INTEGER) AS pos_turning,
  CAST(count(CASE WHEN p > x AND x < q THEN 1 END) AS INTEGER) AS neg_turning, CAST(count(CASE WHEN sign(x - m) <> sign(p - m) THEN 1 END) AS INTEGER) AS mean_crossings,
  CAST(count(CASE WHEN sign(x) <> sign(p) THEN 1 END) AS INTEGER) AS zero_crossings, max(x) - min(x) AS peak_to_peak,
  CAST(count(CASE WHEN peak THEN 1 END) AS INTEGER) AS neighbourhood_peaks FROM sp2 GROUP BY {keys}),
sp4 AS (SELECT *, CASE WHEN n > 1 THEN abs_energy / (n - 1) END AS average_power, {n20} AS ecdf_n20, {n80} AS ecdf_n80,
  CASE WHEN {n20} > 0 THEN srt[{n20}] END AS ecdf_p20, CASE WHEN {n80} > 0 THEN srt[{n80}] END AS ecdf_p80,
  0.25 / nullif(srt[{n75}] - CASE WHEN {n50} > 0 THEN srt[{n50}] END, 0) AS ecdf_slope FROM sp3),
sp AS (SELECT {keys}, {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in whole)}, {", ".join(f"round({c}, 6) AS {c}" for c in rounded)} FROM sp4)"""
