"""Fitted imputers, series features, pseudonyms and draws against plain
NumPy and Python."""

from __future__ import annotations

import hashlib
import hmac
import random

import numpy as np
import pytest
from conftest import SMALL, rows
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wardflow.operators import imputers as I
from wardflow.operators import privacy as PV
from wardflow.operators import series as SE
from wardflow.plans.q_evaluation import draw_rows

COLS = ["a", "b", "c"]


def _table(seed, n=400):
    rng = np.random.default_rng(seed)
    a = rng.normal(50, 10, n)
    b = 2 * a + rng.normal(0, 3, n)
    c = 100 - a + 0.3 * b + rng.normal(0, 5, n)
    x = np.column_stack([a, b, c])
    x[rng.random(x.shape) < [0.1, 0.3, 0.2]] = np.nan
    return x


def _frame(spark, x):
    return spark.createDataFrame([(i, *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)], "k long, a double, b double, c double")


def _row_by_row(train, apply, rounds, ridge):
    """The same rounds on whole tables: fit on the training rows, predict the
    missing cells of both."""
    mean = np.nanmean(train, axis=0)
    order = np.argsort(np.isnan(train).sum(axis=0), kind="stable")
    tables = [np.where(np.isnan(t), mean, t) for t in (train, apply)]
    for _ in range(rounds):
        for c in order:
            others = [i for i in range(train.shape[1]) if i != c]
            seen = ~np.isnan(train[:, c])
            x, y = tables[0][seen][:, others], train[seen, c]
            xm, ym = x.mean(axis=0), y.mean()
            if ridge:
                b = I.evidence_ridge((x - xm).T @ (x - xm), (x - xm).T @ (y - ym), float((y - ym) @ (y - ym)), len(y))
            else:
                b = np.linalg.lstsq(x - xm, y - ym, rcond=None)[0]
            for t, source in zip(tables, (train, apply)):
                t[:, c] = np.where(np.isnan(source[:, c]), ym + (t[:, others] - xm) @ b, source[:, c])
    return tables[1]


@pytest.mark.parametrize("regression", ["ols", "evidence"])
def test_chained_linear_equals_the_rounds_on_rows(spark, regression):
    train, other = _table(1), _table(2, 120)
    other[0] = np.nan
    model = I.ChainedLinear(COLS, max_rounds=6, tol=0.0, regression=regression).fit(_frame(spark, train))
    assert model.rounds == 6 and not model.converged
    got = {r.k: (r.a, r.b, r.c) for r in model.transform(_frame(spark, other)).collect()}
    want = _row_by_row(train, other, 6, regression == "evidence")
    assert np.allclose([got[i] for i in range(len(other))], want, rtol=1e-7)


def test_chained_linear_converges_and_keeps_observed(spark):
    x = _table(3)
    df = _frame(spark, x)
    short = I.ChainedLinear(COLS).fit(df)               # nearly collinear columns settle slowly
    assert short.rounds == 30 and not short.converged
    model = Pipeline(stages=[I.ChainedLinear(COLS, max_rounds=200)]).fit(df)
    linear = model.stages[0]
    assert linear.converged and 30 < linear.rounds < 200 and linear.changes[-1] < linear.changes[0]
    got = np.array([(r.a, r.b, r.c) for r in model.transform(df).orderBy("k").collect()])
    seen = ~np.isnan(x)
    assert (got[seen] == x[seen]).all() and not np.isnan(got).any()
    assert np.abs(got[:, 1] - 2 * got[:, 0])[~seen[:, 1] & seen[:, 0]].mean() < 5
    assert I.ChainedLinear(COLS).fit(df.filter("false")).transform(df.limit(3)).count() == 3


def test_evidence_ridge_is_least_squares_with_many_rows():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(5000, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=5000)
    x, y = x - x.mean(axis=0), y - y.mean()
    b = I.evidence_ridge(x.T @ x, x.T @ y, float(y @ y), 5000)
    assert np.allclose(b, np.linalg.lstsq(x, y, rcond=None)[0], atol=2e-3)
    few = rng.normal(size=(8, 3))
    noise = rng.normal(size=8)
    few, noise = few - few.mean(axis=0), noise - noise.mean()
    shrunk = I.evidence_ridge(few.T @ few, few.T @ noise, float(noise @ noise), 8)
    assert np.abs(shrunk).sum() < np.abs(np.linalg.lstsq(few, noise, rcond=None)[0]).sum()


def test_chained_linear_of_more_columns_uses_the_joined_table(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6))
    x[rng.random(x.shape) < 0.2] = np.nan
    cols = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([(i, *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)], "k long, " + ", ".join(f"{c} double" for c in cols))
    got = np.array([r[1:] for r in I.ChainedLinear(cols, max_rounds=3, tol=0.0, regression="ols").fit(df).transform(df).orderBy("k").collect()])
    assert np.allclose(got, _row_by_row(x, x.copy(), 3, False), rtol=1e-6, atol=1e-9)


def test_chained_forest_is_fitted_once_and_replayed(spark):
    x = _table(4, 200)
    df = _frame(spark, x)
    model = I.ChainedForest(COLS, max_rounds=3, trees=5).fit(df)
    assert 1 <= model.rounds <= 3 and len(model.changes) == model.rounds
    other = _table(6, 80)
    got = np.array([(r.a, r.b, r.c) for r in model.transform(_frame(spark, other)).orderBy("k").collect()])
    seen = ~np.isnan(other)
    assert (got[seen] == other[seen]).all() and not np.isnan(got).any()
    filled = ~seen[:, 1] & seen[:, 0]
    assert np.abs(got[:, 1] - 2 * got[:, 0])[filled].mean() < np.abs(np.nanmean(x[:, 1]) - 2 * got[:, 0])[filled].mean()
    assert model.transform(_frame(spark, other)).columns == ["k", *COLS]


def _features(x):
    n, m = len(x), np.mean(x)
    d, srt = np.diff(x), np.sort(x)
    _, counts = np.unique(x, return_counts=True)
    p = counts / n
    lo, hi = min(x), max(x)
    hist = [0] * SE.HIST_BINS
    for v in x:
        hist[min(int((v - lo) / (hi - lo) * SE.HIST_BINS), SE.HIST_BINS - 1) if hi > lo else SE.HIST_BINS // 2] += 1
    cross = lambda y: sum(np.sign(a) != np.sign(b) for a, b in zip(y, y[1:]))
    ecdf = lambda q: int(n * q + 1e-9)
    k = SE.NEIGHBOURS
    return {
        "n": n, "mean": m, "std": np.std(x), "var": np.var(x), "median": np.median(x), "iqr": np.subtract(*np.percentile(x, [75, 25])),
        "rms": np.sqrt(np.mean(np.square(x))), "abs_energy": np.sum(np.square(x)), "average_power": np.sum(np.square(x)) / (n - 1) if n > 1 else None,
        "mean_abs_dev": np.mean(np.abs(x - m)), "median_abs_dev": np.median(np.abs(x - np.median(x))),
        "skewness": np.mean((x - m) ** 3) / np.var(x) ** 1.5 if hi > lo else None, "kurtosis": np.mean((x - m) ** 4) / np.var(x) ** 2 - 3 if hi > lo else None,
        "entropy": abs(np.sum(p * np.log2(p))) / np.log2(n) if n > 1 else None, "ecdf_n20": ecdf(0.2), "ecdf_n80": ecdf(0.8),
        "ecdf_p80": srt[ecdf(0.8) - 1] if ecdf(0.8) else None, **{f"hist_{i}": h for i, h in enumerate(hist)},
        "autocorr_lag1": np.corrcoef(x[1:], x[:-1])[0, 1] if n > 2 and hi > lo else None,
        "area": np.sum(np.abs(x[1:] + x[:-1])) / 2 if n > 1 else None,
        "centroid": np.sum(np.arange(n) * np.square(x)) / np.sum(np.square(x)), "mean_diff": np.mean(d) if n > 1 else None,
        "median_diff": np.median(d) if n > 1 else None, "median_abs_diff": np.median(np.abs(d)) if n > 1 else None,
        "sum_abs_diff": np.sum(np.abs(d)) if n > 1 else None, "distance": np.sum(np.sqrt(1 + d * d)) if n > 1 else None,
        "slope": np.polyfit(range(n), x, 1)[0] if n > 1 else None, "zero_crossings": cross(x), "mean_crossings": cross(x - m),
        "pos_turning": sum(a < b > c for a, b, c in zip(x, x[1:], x[2:])), "neg_turning": sum(a > b < c for a, b, c in zip(x, x[1:], x[2:])),
        "peak_to_peak": hi - lo,
        "neighbourhood_peaks": sum(all(x[i] > x[i + j] and x[i] > x[i - j] for j in range(1, k + 1)) for i in range(k, n - k)),
    }


def test_series_profile_against_numpy(spark):
    rng = np.random.default_rng(3)
    series = [rng.normal(0, 5, 20).round(1), rng.normal(80, 9, 48), np.full(10, 7.0), np.array([4.0]), np.array([1.0, 2.0]), np.sin(np.arange(30) / 2) * 5]
    rows = [(i, [float(v) for v in s]) for i, s in enumerate(series)] + [(98, []), (99, [None, None])]
    rows[4] = (4, [None, 1.0, None, 2.0])
    got = {r.k: r for r in SE.series_profile(spark.createDataFrame(rows, "k int, s array<double>"), ["k"], "s").collect()}
    assert set(got) == set(range(len(series)))
    for i, s in enumerate(series):
        for name, want in _features(s).items():
            have = got[i][name]
            assert (have is None) == (want is None) and (want is None or abs(have - want) < 2e-6 * max(1, abs(want))), (i, name, have, want)


def test_pseudonyms_are_keyed_and_lead_back(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (None, "z", 7)], "id long, name string, v int")
    key = b"k" * 20
    out = PV.pseudonymise(df, "id", ["name"], key)
    assert out.columns == ["pseudo_id", "v"]
    got = {r.v: r.pseudo_id for r in out.collect()}
    assert got[5] == hmac.new(key, b"1", hashlib.sha256).hexdigest() and got[7] is None
    table = {r.pseudo_id: (r.id, r.name) for r in PV.correspondence(df, "id", ["name"], key).collect()}
    assert table[got[6]] == (2, "y")
    assert PV.pseudonymise(df, "id", ["name"], b"other").filter("v = 5").first()[0] != got[5]
    spark.conf.set(PV.KEY, "set")
    assert PV.pseudonym_key(spark) == b"set"
    spark.conf.unset(PV.KEY)
    drawn = PV.pseudonym_key(spark)
    assert len(drawn) == 64 and PV.pseudonym_key(spark) == drawn


def _cohort_ids(name, con):
    if name == "static_cohort":
        return con.sql(f"SELECT c_custkey FROM '{SMALL}/customer.parquet' WHERE c_acctbal > 0 AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') "
                       f"AND c_custkey IN (SELECT o_custkey FROM '{SMALL}/orders.parquet')").fetchall()
    return con.sql(f"SELECT doc_id FROM '{SMALL}/documents.parquet' JOIN '{SMALL}/labels.parquet' USING (doc_id)").fetchall()


@pytest.mark.parametrize("name", ["static_cohort", "sepsis_demo"])
def test_cohort_rows_keep_their_pseudonyms(spark, name):
    import duckdb

    import __spark_entry__ as entry_mod
    con = duckdb.connect()
    for t in ("customer", "orders", "nation", "documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    ids = {hmac.new(PV.PUBLISHED, str(i).encode(), hashlib.sha256).hexdigest() for i, in _cohort_ids(name, con)}
    spark.conf.unset(PV.KEY)
    PV.pseudonym_key(spark)                             # a key drawn for other queries leaves these alone
    df = entry_mod.queries()[name](spark, SMALL)
    got = rows(df)
    sql = con.sql(entry_mod.oracle_sql()[name])
    assert df.columns == sql.columns and df.columns[0] == "pseudo_id"
    assert [r[0] for r in got] == sorted(r[0] for r in sql.fetchall()) and got
    assert len({r[0] for r in got}) == len(got) and {r[0] for r in got} <= ids
    if name == "static_cohort":
        assert {r[0] for r in got} == ids
    spark.conf.set(PV.KEY, "own")
    try:
        own = rows(entry_mod.queries()[name](spark, SMALL))
    finally:
        spark.conf.unset(PV.KEY)
    assert len(own) == len(got) and not {r[0] for r in own} & {r[0] for r in got}


def test_draw_with_replacement_is_exact_and_stable(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.random()) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, x double")
    got = [sorted(tuple(r) for r in draw_rows(df.repartition(n), ["k"], 500, 3).collect()) for n in (1, 7)]
    assert got[0] == got[1] and [r[0] for r in got[0]] == list(range(500))
    assert len({r[1] for r in got[0]}) > 35 and all(r[2] == dict(rows)[r[1]] for r in got[0])
    assert draw_rows(df.filter("k = 3"), ["k"], 5, 3).select(F.countDistinct("k")).first()[0] == 1
