"""Masks, imputers, splits, encoders and model helpers: invariants and
brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from wardflow.operators import masking as M
from wardflow.operators import models as MD
from wardflow.operators import relational as R


def _panel(spark, seed=1, n_e=20, n_t=20):
    rnd = random.Random(seed)
    data = [(e, t, f, None if rnd.random() < 0.2 else round(rnd.uniform(40, 120), 2))
            for e in range(n_e) for t in range(n_t) for f in ("a", "b")]
    return data, spark.createDataFrame(data, "e long, t long, f string, x double")


def test_random_mask_only_removes(spark):
    data, df = _panel(spark)
    u = M.uniform_hash(F.col("e"), F.col("t"), M.feature_index("f", ["a", "b"]), 42)
    out = df.withColumn("m", M.random_mask("x", u, 0.3)).collect()
    assert all(r.m is None or r.m == r.x for r in out)
    observed = [r for r in out if r.x is not None]
    share = sum(r.m is None for r in observed) / len(observed)
    assert 0.2 < share < 0.4


def test_draws_are_independent_and_take_any_key(spark):
    n, bins, rate = 3000, 20, 0.3
    x = spark.range(n).selectExpr("id * 50 AS e", f"explode(sequence(0, {bins - 1})) AS t")
    u = [M.uniform_hash(F.col("e"), F.col("t"), F.lit(f), 42) < rate for f in (1, 2)]
    x = x.select("e", "t", u[0].alias("a"), u[1].alias("b"))
    near = x.alias("x").join(x.selectExpr("e", "t - 1 AS t", "a AS after"), ["e", "t"])
    r = x.agg(F.avg(F.col("a").cast("int")), F.avg((F.col("a") & F.col("b")).cast("int"))).first()
    adjacent = near.agg(F.avg((F.col("a") & F.col("after")).cast("int"))).first()[0]
    assert abs(r[0] - rate) < 0.01 and abs(r[1] - rate ** 2) < 0.006 and abs(adjacent - rate ** 2) < 0.006
    for step in (1, 10, 50, 100):
        ids = spark.range(4000).select((F.col("id") * step + 9 * 10 ** 18 // 100 * 100 - 4000 * step).alias("k"))
        share = {q[0]: q[1] / 4000 for q in ids.groupBy(MD.hash_split(F.col("k"))).count().collect()}
        assert abs(share["train"] - 0.70) < 0.03 and abs(share["val"] - 0.15) < 0.025
    text = spark.createDataFrame([(f"patient-{i}",) for i in range(50)], "k string")
    assert text.select(MD.hash_split(F.col("k")).alias("s")).distinct().count() > 1


def test_block_scenarios_reach_the_target_share(spark):
    rnd = random.Random(5)
    data = [(2 ** 60 + e, t, float(e), None if rnd.random() < 0.2 else 1.0) for e in range(40) for t in range(20)]
    df = spark.createDataFrame(data, "e long, t long, a double, b double")
    sc = [{"scenario": "two", "n": 2, "only": None, "rate": 0.3, "seed": 1}, {"scenario": "b4", "n": 4, "only": "b", "rate": 0.3, "seed": 2}]
    long = M.masked_long(M.target_share_masks(df, "e", "t", ["a", "b"], sc, 20), "e", "t", ["a", "b"]).collect()
    gone = {s: sum(r.original is not None and r.masked is None for r in long if r.scenario == s) for s in ("two", "b4")}
    assert 480 <= gone["two"] < 480 + 4 and 240 <= gone["b4"] < 240 + 4
    assert all(r.masked == r.original for r in long if r.t == 19 or (r.scenario == "b4" and r.feature == "a"))


def test_imputers_keep_observed_and_fill(spark):
    _data, df = _panel(spark)
    u = M.uniform_hash(F.col("e"), F.col("t"), M.feature_index("f", ["a", "b"]), 42)
    imp = M.impute_all(df.withColumn("m", M.random_mask("x", u, 0.3)), ["e", "f"], "t", "m").collect()
    for r in imp:
        for c in M.METHODS:
            if r.m is not None:
                assert r[c] == r.m
            else:
                assert r[c] is not None
    errs = M.errors(spark.createDataFrame(imp), ["f"], "x", "m", "imp_linear").collect()
    assert all(e.n > 0 and e.mae >= 0 and e.rmse >= e.mae for e in errs)


def test_stratified_split_exact_and_disjoint(spark):
    rnd = random.Random(3)
    data = [(i, int(rnd.random() < 0.3)) for i in range(500)]
    df = spark.createDataFrame(data, "k long, y int")
    out = MD.stratified_split(df, "k", "y").collect()
    assert len(out) == 500 and len({r.k for r in out}) == 500
    for y in (0, 1):
        grp = [r for r in out if r.y == y]
        n = len(grp)
        assert sum(r.split == "train" for r in grp) == sum(1 for i in range(n) if i / n < 0.6)


def test_hash_split_by_entity(spark):
    df = spark.createDataFrame([(e, t) for e in range(50) for t in range(3)], "e long, t long")
    out = df.withColumn("s", MD.hash_split(F.col("e"))).groupBy("e").agg(F.countDistinct("s").alias("n"))
    assert all(r.n == 1 for r in out.collect())


def test_standardise_inverse_and_label_encode(spark):
    data, df = _panel(spark)
    z = MD.standardise_long(df, "f", "x").withColumn("back", MD.inverse_standardise("z")).collect()
    assert all(r.x is None or abs(r.back - r.x) < 1e-9 for r in z)
    xa = np.array([x for _e, _t, f, x in data if f == "a" and x is not None])
    za = np.array([r.z for r in z if r.f == "a" and r.z is not None])
    assert abs(za.mean()) < 1e-9 and abs(za.std() - 1) < 1e-9 and len(za) == len(xa)
    c = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "s string")
    codes = {r.s: r.code for r in MD.label_encode(c, "s", "code").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, None: None}


def test_vif_matches_numpy(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(200, 3))
    x[:, 2] = x[:, 0] * 0.8 + rnd.normal(scale=0.3, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = dict(MD.vif(df, ["a", "b", "c"]))
    s = x.T @ x / len(x)
    inv = np.linalg.inv(s)
    for k, c in enumerate("abc"):
        assert abs(got[c] - s[k, k] * inv[k, k]) < 1e-6


def test_stratified_folds_are_even_in_every_class(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(103)], "k long, y int").repartition(5)
    out = MD.stratified_folds(df, "k", "y").collect()
    for y in (0, 1):
        sizes = [sum(r.y == y and r.fold == f for r in out) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(r.y == y for r in out)


def test_first_per_key_mixed_directions_nulls_first(spark):
    data = [(1, None, 5.0, 1), (1, 3, 1.0, 2), (1, 3, 0.5, 3), (2, 1, 2.0, 4), (2, 2, None, 5), (2, 2, 9.0, 6)]
    df = spark.createDataFrame(data, "k long, d long, p double, id long")
    got = {r.k: r.id for r in R.first_per_key(df, ["k"], [("d", True), ("p", False), ("id", True)], ["id"]).collect()}
    # k=1: d desc nulls first -> the null row first; k=2: d=2 rows, p asc nulls first -> id 5
    assert got == {1: 1, 2: 5}


def test_first_per_key_descending_texts(spark):
    words = ["a", "ab", "abc", "b", "", "é", "z", "~", "aé", "a\x00", "漢字"]
    df = spark.createDataFrame([(1, w, i) for i, w in enumerate(words)] + [(2, None, 90), (2, "x", 91), (3, "x", 92), (3, "x", 93)], "k int, w string, id int")
    got = {r.k: r.id for r in R.first_per_key(df, ["k"], [("w", True), ("id", True)], ["id"]).collect()}
    assert got == {1: max(range(len(words)), key=lambda i: words[i].encode()), 2: 90, 3: 93}
    order = [r.w for r in df.filter("k = 1").orderBy(R._order_key(df, "w", True)).collect()]
    assert order == sorted(words, key=str.encode, reverse=True)


def test_series_features_vs_numpy(spark):
    xs = [3.0, 5.0, 4.0, 8.0, 6.0, 7.0, 2.0]
    df = spark.createDataFrame([(1, t, x) for t, x in enumerate(xs)], "e long, t long, x double")
    r = MD.series_features(df, "e", "t", "x").first()
    a = np.array(xs)
    assert abs(r.mean - a.mean()) < 1e-6 and abs(r.std - a.std(ddof=1)) < 1e-6
    assert abs(r.rms - np.sqrt((a ** 2).mean())) < 1e-6 and abs(r.slope - np.polyfit(range(7), a, 1)[0]) < 1e-6
    assert r.pos_turning == 3 and r.neg_turning == 2      # peaks 5, 8, 7; troughs 4, 6
    assert abs(r.sum_abs_diff - np.abs(np.diff(a)).sum()) < 1e-6


def test_classifier_cv_and_persistence(spark):
    """CV-tuned balanced classifier, saved and reloaded."""
    import tempfile

    from pyspark.ml.tuning import CrossValidatorModel
    rnd = random.Random(11)
    rows_ = []
    for i in range(120):
        y = int(rnd.random() < 0.3)
        rows_.append((i, float(y), rnd.gauss(2.0 * y, 1.0), rnd.choice(["en", "fr"]), i % 5))
    df = MD.balanced_weights(spark.createDataFrame(rows_, "k long, y double, x double, lang string, fold int"), "y")
    model = MD.fit_classifier(df, "logreg", cat_cols=["lang"], num_cols=["x"])
    path = tempfile.mkdtemp(prefix="wf-model-")
    model.write().overwrite().save(path)
    again = CrossValidatorModel.load(path)
    a = [r.prediction for r in model.transform(df).orderBy("k").collect()]
    b = [r.prediction for r in again.transform(df).orderBy("k").collect()]
    assert a == b and max(model.avgMetrics) > 0.7


def test_dtw_distance_and_clusters(spark):
    from wardflow.operators.dtw import dtw_kmedoids, dtw_sweep, dtw_to, lower_bound, two_nearest

    def brute(a, b):
        n, m = len(a), len(b)
        d = [[float("inf")] * (m + 1) for _ in range(n + 1)]
        d[0][0] = 0.0
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                d[i][j] = (a[i - 1] - b[j - 1]) ** 2 + min(d[i - 1][j], d[i][j - 1], d[i - 1][j - 1])
        return d[n][m] ** 0.5

    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(5, 8))
    ref = rnd.normal(size=6)
    assert np.allclose(dtw_to(x, ref), [brute(r, ref) for r in x])
    for w in (1, 3):                                     # within the window, and never under the bound
        def banded(a, b, w=w):
            n = len(a)
            d = {(-1, -1): 0.0}
            for i in range(n):
                for j in range(max(0, i - w), min(n, i + w + 1)):
                    d[i, j] = (a[i] - b[j]) ** 2 + min(d.get((i - 1, j), np.inf), d.get((i, j - 1), np.inf), d.get((i - 1, j - 1), np.inf))
            return d[n - 1, n - 1] ** 0.5
        assert np.allclose(dtw_to(x, x[0], w), [banded(r, x[0]) for r in x])
        assert (lower_bound(x, x[0], w) <= dtw_to(x, x[0], w) + 1e-9).all()
    y = np.vstack([np.cumsum(rnd.normal(size=(60, 12)), axis=1) + 5 * k for k in range(4)])
    medoids = y[[3, 70, 130, 200]]
    for w in (None, 2):
        want = np.column_stack([dtw_to(y, m, w) for m in medoids])
        k, near, second, full = two_nearest(y, medoids, w)
        assert (k == want.argmin(axis=1)).all() and np.allclose(near, want.min(axis=1)) and np.allclose(second, np.sort(want, axis=1)[:, 1])
        assert full < want.size or w is None
    # two obvious shapes, shifted in time: DTW puts each shape in one cluster
    rows_ = []
    for i in range(12):
        base = np.sin(np.linspace(0, 3, 15) + (i % 3) * 0.2) * (1 if i < 6 else -1) * 10 + 50
        rows_.append((i, [float(v) for v in base]))
    df = spark.createDataFrame(rows_, "e long, series array<double>")
    got = {r.e: r.cluster for r in dtw_kmedoids(df, "e", 2).collect()}
    assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(6, 12)}) == 1
    assert got[0] != got[6]
    out, ended = dtw_sweep(df, "e", [2, 3, 40], window=4)
    assert set(ended) == {2, 3} and all(ok for _n, ok in ended.values())
    rows2 = [r for r in out.collect() if r.k == 2]
    assert len(rows2) == 12 and all(r.dist <= r.second for r in rows2) and len({r.cluster for r in rows2}) == 2
    assert dtw_sweep(df.filter("false"), "e", [2])[0].count() == 0


def test_target_share_blocks_equal_sequential_rule(spark):
    """J3 computed with window minima + prefix sums equals adding blocks one
    by one in key order until the newly masked observed cells reach the
    target."""
    rnd = random.Random(17)
    H, n, rate, seed, feats = 12, 3, 0.3, 5, ["a", "b"]
    data = [(e, t, *(None if rnd.random() < 0.3 else float(rnd.randint(1, 9)) for _ in feats))
            for e in range(1, 9) for t in range(H)]
    df = spark.createDataFrame(data, "e long, t long, a double, b double")
    got = {(r.e, r.t): (r.m_a, r.m_b) for r in M.target_share_block_mask(df, "e", "t", feats, n, H, rate, seed).collect()}
    keys = sorted((int(hashlib.md5(f"{seed}|{e}|{t}".encode()).hexdigest()[:13], 16), e, t)
                  for e in range(1, 9) for t in range(H - 1))
    obs = {(e, t): [v is not None for v in vals] for e, t, *vals in data}
    target = int(len(data) * len(feats) * rate)
    masked, count = set(), 0
    for _k, e, t0 in keys:
        if count >= target:
            break
        for d in range(t0, min(t0 + n, H - 1)):
            if (e, d) not in masked:
                masked.add((e, d))
                count += sum(obs[(e, d)])
    for e, t, *vals in data:
        exp = tuple(None if (e, t) in masked else v for v in vals)
        assert got[(e, t)] == exp


def test_global_scope_fill_and_materialised_imputations(spark):
    import os
    import tempfile

    from conftest import SMALL
    from wardflow.plans import q_impute as QI
    data = [(e, t, "a", v) for e, vals in [(1, [1.0, None, 3.0]), (2, [10.0, None, None])] for t, v in enumerate(vals)]
    df = spark.createDataFrame(data, "e long, t long, f string, m double")
    per = {(r.e, r.t): r.imp_mean for r in M.impute_all(df, ["e", "f"], "t", "m").collect()}
    glob = {(r.e, r.t): r.imp_mean for r in M.impute_all(df, ["e", "f"], "t", "m", global_keys=["f"]).collect()}
    assert per[(1, 1)] == 2.0 and per[(2, 1)] == 10.0
    assert glob[(1, 1)] == glob[(2, 2)] == (1.0 + 3.0 + 10.0) / 3
    out = os.path.join(tempfile.mkdtemp(prefix="wf-imp-"), "imputed")
    QI.materialise_imputations(QI.scenario_panel(spark, SMALL, ["random", "block2"]), out)
    back = spark.read.parquet(out).filter("scenario = 'random' AND method = 'imp_linear'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and back.count() > 0


def test_training_rows_are_dealt_over_the_cores(spark):
    df = spark.range(42_000).select("id", (F.col("id") % 7).alias("v")).coalesce(1)
    out = MD.spread(df, "id", "spread")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect())) and out.dtypes == df.dtypes
    filled = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(filled) == 4 and max(r["count"] for r in filled) < 12_000      # 4 cores; one task had all rows
    assert MD.spread(df.limit(50), "id", "spread").rdd.getNumPartitions() == 1


def test_held_out_models_share_rows_and_shuffle_no_text(spark):
    from conftest import SMALL

    from wardflow.plans import q_models as QM
    x, train = QM.split_rows(spark, SMALL)
    feats = QM._doc_features(spark, SMALL)
    plan = feats._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):].split("\n")[1]
    assert "log_len" in below and "Project" in below, plan                    # the numbers are made under the join
    assert x.select(feats.columns).exceptAll(feats).count() == 0 and x.count() == feats.count()
    assert train.count() == x.filter("split = 'train'").count() and {"w", "fold"} < set(train.columns)


def test_all_kinds_of_model_read_one_split(spark, monkeypatch):
    from wardflow.plans import q_models as QM
    made, seen = [], []

    def split(*_a):
        made.append(object())
        return made[-1]

    def fitted(spark, _dir, kind, _grid, rows=None):
        seen.append((kind, rows))
        return spark.createDataFrame([(1, 1.0, "val", 0.9, 1)], "doc_id long, y double, split string, prob double, pred int")

    monkeypatch.setattr(QM, "split_rows", split)
    monkeypatch.setattr(QM, "held_out", fitted)
    assert QM.held_out_rows(spark, "unused").count() == 3
    assert len(made) == 1 and [k for k, _ in seen] == list(QM.ONE_POINT) and all(r is made[0] for _, r in seen)
