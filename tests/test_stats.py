"""Statistics operators against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.functions import scalar as SC
from wardflow.operators import stats as ST
from wardflow.operators.ranks import number_rows, running, running_sums, sorted_ranges


def _scored(seed, n=300, groups=("x", "y", "z")):
    rnd = random.Random(seed)
    return [(g, round(rnd.choice([0.1, 0.2, 0.25, 0.5, 0.7, 0.9]) if rnd.random() < 0.5 else rnd.random(), 2),
             int(rnd.random() < 0.4)) for g in groups for _ in range(n // len(groups))]


def _auc_brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    u = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return u / (len(pos) * len(neg))


def test_auc_by_group_with_ties(spark):
    data = _scored(1) + [("only_pos", 0.3, 1), ("only_pos", 0.4, 1)]
    df = spark.createDataFrame(data, "g string, s double, y int")
    got = {r.g: r.auc for r in ST.auc_by_group(df, ["g"], "s", "y").collect()}
    for g in set(d[0] for d in data):
        ref = _auc_brute([(s, y) for gg, s, y in data if gg == g])
        assert (got[g] is None and ref is None) or abs(got[g] - ref) < 1e-6


def test_best_f2_threshold(spark):
    data = _scored(2)
    df = spark.createDataFrame(data, "g string, s double, y int")
    best = ST.best_threshold(ST.pr_curve(df, "s", "y")).first()
    P = sum(y for _g, _s, y in data)
    cands = []
    for thr in sorted(set(s for _g, s, _y in data)):
        tp = sum(1 for _g, s, y in data if s >= thr and y == 1)
        fp = sum(1 for _g, s, y in data if s >= thr and y == 0)
        p, r = tp / (tp + fp), tp / P
        f2 = 5 * p * r / (4 * p + r) if (4 * p + r) else None
        cands.append((thr, f2))
    mx = max(f for _t, f in cands if f is not None)
    thr = min(t for t, f in cands if f is not None and abs(f - mx) < 1e-12)
    assert abs(best.threshold - thr) < 1e-9 and abs(best.f2 - round(mx, 6)) < 1e-6


def test_quantile_bins_right_closed(spark):
    xs = [float(i) for i in range(1, 101)] + [None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.x: r.bin for r in ST.quantile_bin(df, "x", 10).collect()}
    edges = np.percentile([x for x in xs if x is not None], [10 * k for k in range(1, 10)])
    for x in xs:
        if x is None:
            assert got[None] is None
        else:
            assert got[x] == int(sum(1 for e in set(edges) if e < x))
    assert got[1.0] == 0 and got[100.0] == 9


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(6)
    xs = [round(rnd.gauss(50, 20), 1) for _ in range(997)] + [50.0] * 300     # a hot value
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    qs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999]
    got = ST.exact_quantiles(df, "x", qs).first().q
    ref = np.percentile(xs, [q * 100 for q in qs])
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, ref)), (got, ref)


def test_confusion_complete_grid(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.95)], "y int, s double")
    got = {(r.label, r.pred): r.n for r in ST.confusion(df, "y", F.col("s") > 0.5).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def test_t_quantile(spark):
    ref = {1: 12.70620474, 2: 4.30265273, 3: 3.182446305, 4: 2.776445105, 10: 2.228138852, 30: 2.042272456,
           48: 2.010634758, 100: 1.983971519, 1000: 1.962339081}
    df = spark.createDataFrame([(k,) for k in ref], "n long")
    got = {r.n: r.t for r in df.select("n", SC.t_quantile_975("n").alias("t")).collect()}
    for k, v in ref.items():
        assert abs(got[k] - v) < (5e-6 if k == 3 else 1e-6), (k, got[k], v)


def test_scalar_expressions(spark):
    df = spark.createDataFrame([(x,) for x in [-2.0, -0.3, 0.0, 0.7, 1.5, 3.0]], "x double")
    got = df.select("x", SC.erf("x").alias("e"), SC.normal_sf("x").alias("sf")).collect()
    for r in got:
        assert abs(r.e - math.erf(r.x)) < 2e-7
        assert abs(r.sf - 0.5 * math.erfc(r.x / math.sqrt(2))) < 2e-7
    t = spark.createDataFrame([("Mortalité prédite : 12,5%",), ("bad",), ("3%",), (None,)], "s string")
    assert [r.p for r in t.select(SC.parse_percent("s").alias("p")).collect()] == [0.125, None, 0.03, None]


def test_regression_ci_matches_numpy(spark):
    rnd = random.Random(3)
    pts = [(x, 2.0 * x + 1 + rnd.gauss(0, 1)) for x in [rnd.uniform(0, 10) for _ in range(50)]]
    df = spark.createDataFrame([("g", x, y) for x, y in pts], "g string, x double, y double")
    r = ST.regression_ci(df, ["g"], "y", "x").first()
    x = np.array([p[0] for p in pts])
    y = np.array([p[1] for p in pts])
    b1, b0 = np.polyfit(x, y, 1)
    resid = y - (b1 * x + b0)
    s2 = (resid ** 2).sum() / (len(x) - 2)
    se1 = math.sqrt(s2 / ((x - x.mean()) ** 2).sum())
    assert abs(r.slope - b1) < 1e-5 and abs(r.intercept - b0) < 1e-5 and abs(r.se_slope - se1) < 1e-5
    assert abs((r.slope_hi - r.slope) / se1 - 2.010634758) < 1e-3   # t(0.975, 48)


def test_row_numbers_and_running_sums(spark):
    rnd = random.Random(4)
    data = [(rnd.choice([0, 1, 2, None]), rnd.choice([None, *range(50)]), i) for i in range(200)]
    df = spark.createDataFrame(data, "g long, v long, id long").repartition(3)
    out = {r.id: r for r in number_rows(df, [F.col("v").asc_nulls_first(), F.col("id").asc()], ["g"], "rk", "n").collect()}
    sums = {r.id: r.cum_id for r in running_sums(df, [F.col("v").asc_nulls_first(), F.col("id").asc()], ["id"], ["g"]).collect()}
    for g in (0, 1, 2, None):
        grp = sorted((v is not None, v or 0, i) for gg, v, i in data if gg == g)
        assert [out[i].rk for *_v, i in grp] == list(range(len(grp))) and {out[i].n for *_v, i in grp} == {len(grp)}
        assert [sums[i] for *_v, i in grp] == list(np.cumsum([i for *_v, i in grp]))
    glob = {r.id: r.number for r in number_rows(df, [F.col("v").desc_nulls_last(), F.col("id").asc()]).collect()}
    order = [i for *_v, i in sorted((v is None, -(v or 0), i) for _g, v, i in data)]
    assert [glob[i] for i in order] == list(range(200))
    assert number_rows(df.filter("false"), [F.col("id").asc()], ["g"]).count() == 0


def test_running_maximum_and_last_value(spark):
    rnd = random.Random(9)
    data = [(rnd.choice(["a", "b", None]), i, rnd.choice([None, rnd.random()])) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i long, x double").repartition(4)
    got = {r.i: r for r in running(df, [F.col("i").desc()], {"top": ("max", "x"), "low": ("min", "x"), "held": ("last", "x"), "prev": ("lag", "x")}, ["g"]).collect()}
    for g in ("a", "b", None):
        seen, prev = [], None
        for _g, i, x in sorted((d for d in data if d[0] == g), key=lambda d: -d[1]):
            assert got[i].prev == prev
            prev = x
            seen += [x] if x is not None else []
            assert (got[i].top, got[i].low, got[i].held) == ((max(seen), min(seen), seen[-1]) if seen else (None, None, None))


@pytest.mark.parametrize("case", ["outlier", "equal scores"])
def test_sampled_ranges_stay_even(spark, case):
    """One far outlier, or nine tenths of the rows equal: no range holds more
    than twice the mean."""
    n = 20_000
    value = F.when(F.col("id") == 0, 1e12).otherwise(F.rand(1)) if case == "outlier" else F.when(F.col("id") % 10 > 0, 0.5).otherwise(F.rand(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in sorted_ranges(spark.range(n, numPartitions=5).withColumn("x", value), [F.col("x").asc()]).groupBy("_part").count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == n and len(sizes) == 4 and max(sizes) <= 2 * n / 4


def test_bland_altman_and_profile(spark):
    rnd = random.Random(5)
    pairs = [(rnd.uniform(50, 100), rnd.uniform(50, 100)) for _ in range(40)]
    df = spark.createDataFrame([("f", a, b) for a, b in pairs], "f string, a double, b double")
    r = ST.bland_altman(df, ["f"], "a", "b").first()
    d = np.array([b - a for a, b in pairs])
    assert abs(r.bias - d.mean()) < 1e-6 and abs(r.sd - d.std(ddof=1)) < 1e-6
    p = ST.profile(df, ["a"]).first()
    assert p["count"] == 40 and abs(p.p50 - np.percentile([a for a, _ in pairs], 50)) < 1e-6


def test_probit_matches_the_standard_library(spark):
    from statistics import NormalDist

    from wardflow.plans.q_cohorts import _probit
    ps = [1e-300, 1e-20, 1e-12, 1e-6, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.7, 0.92499, 0.92501, 0.999, 1 - 1e-9, 1 - 1e-15]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", _probit(F.col("p")).alias("z")).collect()
    for r in rows:
        assert abs(r.z - NormalDist().inv_cdf(r.p)) < 1e-9
