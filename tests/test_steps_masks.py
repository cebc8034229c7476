"""Resumable steps, tolerant source union, result tables, and the pluggable
masks against plain Python."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.operators import masking as M
from wardflow.operators import models as MD
from wardflow.sources import io
from wardflow.sources.steps import Steps, fingerprint


def test_a_killed_run_continues_where_it_stopped(spark, tmp_path):
    ran = []

    def run(fail_at=None, name="job v1"):
        steps = Steps(spark, name, str(tmp_path))
        for k in range(4):
            def make(k=k):
                ran.append(k)
                if k == fail_at:
                    raise RuntimeError("killed")
                return spark.range(k + 1)
            steps.table(f"s{k}", make)
        return [steps.table(f"s{k}", lambda: 1 / 0).count() for k in range(4)]

    with pytest.raises(RuntimeError):
        run(fail_at=2)
    assert ran == [0, 1, 2] and not Steps(spark, "job v1", str(tmp_path)).complete("s2")
    # a step that had written, but not ended, is repeated
    spark.range(99).write.parquet(Steps(spark, "job v1", str(tmp_path)).path("s2"))
    assert run() == [1, 2, 3, 4] and ran == [0, 1, 2, 2, 3]
    assert run() == [1, 2, 3, 4] and len(ran) == 5
    run(name="job v2")
    assert len(ran) == 9


def test_fingerprint_follows_the_files(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(10).write.parquet(a)
    first = fingerprint(spark.read.parquet(a))
    assert first == fingerprint(spark.read.parquet(a))
    spark.range(11).write.parquet(b)
    assert first != fingerprint(spark.read.parquet(b))
    spark.range(3).write.mode("append").parquet(a)
    assert first != fingerprint(spark.read.parquet(a))


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_partitions(spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "y", 3)], "s string, m string, v int"), path, ["s", "m"])
    io.write_partitions(spark.createDataFrame([("b", "x", 9)], "s string, m string, v int"), path, ["s", "m"])
    assert sorted((r.s, r.m, r.v) for r in spark.read.parquet(path).collect()) == [("a", "x", 1), ("b", "x", 9), ("b", "y", 3)]


def test_broken_sources_are_logged_and_the_rest_is_read(spark, tmp_path):
    p = {n: str(tmp_path / n) for n in ("hr", "fio2", "text", "broken", "gone", "short", "empty")}
    spark.createDataFrame([(1, 2.5), (2, 3.5)], "id long, value double").write.parquet(p["hr"])
    spark.createDataFrame([(3, 4)], "id int, value int").write.parquet(p["fio2"])                   # both widen
    spark.createDataFrame([(4, "x")], "id long, value string").write.parquet(p["text"])             # no number
    spark.createDataFrame([(5,)], "id long").write.parquet(p["short"])                              # no value at all
    spark.createDataFrame([], "id long, value double").write.parquet(p["empty"])
    os.makedirs(p["broken"])
    with open(p["broken"] + "/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    out, log = io.read_sources_tolerant(spark, p, "id long, value double")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([("hr", 1, 2.5), ("hr", 2, 3.5), ("fio2", 3, 4.0), ("short", 5, None)], key=repr)
    got = {r.feature: (r.ok, r.error) for r in log.collect()}
    assert {n for n, (ok, _) in got.items() if not ok} == {"text", "broken", "gone"}
    assert "value" in got["text"][1] and "PATH_NOT_FOUND" in got["gone"][1] and got["hr"] == (True, None)
    none, log = io.read_sources_tolerant(spark, {"gone": p["gone"]}, "id long, value double")
    assert none.count() == 0 and none.columns == ["feature", "id", "value"] and log.filter("ok").count() == 0


def test_metric_table_is_rounded_ordered_and_one_file(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("b", 1.23456, 7), ("a", 2.0, 8)], "method string, mae double, n int").repartition(2)
    io.write_metric_table(df, path, 3)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1 and open(f"{path}/{files[0]}").read().split() == ["method,mae,n", "a,2.0,8", "b,1.235,7"]


FEATS = ["a", "b"]


def _panel(spark, n_e=30, n_t=20, seed=2):
    rnd = random.Random(seed)
    rows = [(f"e{e}", t, *(None if rnd.random() < 0.15 else float(rnd.randrange(90)) for _ in FEATS)) for e in range(n_e) for t in range(n_t)]
    return rows, spark.createDataFrame(rows, "e string, t long, a double, b double").repartition(5)


def _digest(*key):
    return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:13], 16) / 2 ** 52


@pytest.mark.parametrize("rate", [0.1, 0.3, 0.7])
def test_random_mask_repeats_until_the_target(spark, rate):
    rows, df = _panel(spark)
    got = {(r.e, r.t): (r.m_a, r.m_b) for r in M.masked_panel(df, "e", "t", FEATS, M.random_until_target, rate=rate, seed=4).collect()}
    cells = {(e, t, j): v for e, t, *vs in rows for j, v in enumerate(vs) if v is not None}
    goal, p, k = len(cells) * (1 - rate), rate, 0
    left = dict(cells)
    while len(left) > goal:
        left = {c: v for c, v in left.items() if not _digest(c[0], c[1], c[2] + 1, 4, k) < p}
        p, k = p / 2, k + 1
    assert {(e, t, j): v for (e, t), vs in got.items() for j, v in enumerate(vs) if v is not None} == left
    assert len(left) <= goal and len(got) == len(rows)


def test_counted_blocks(spark):
    rows, df = _panel(spark)
    n, horizon, rate, seed = 3, 20, 0.3, 9
    got = {(r.e, r.t): (r.m_a, r.m_b) for r in M.masked_panel(df, "e", "t", FEATS, M.counted_blocks, n=n, horizon=horizon, rate=rate, seed=seed, only=["b"]).collect()}
    entities = sorted({e for e, *_ in rows})
    hit = set()
    for i in range(int(len(entities) * horizon * rate / n)):
        e, t0 = entities[int(_digest(seed, i, 0) * len(entities))], int(_digest(seed, i, 1) * horizon)
        hit |= {(e, t) for t in range(t0, min(t0 + n, horizon - 1))}
    assert hit and got == {(e, t): (a, None if (e, t) in hit else b) for e, t, a, b in rows}


def test_any_function_is_a_mask_and_only_removes(spark):
    rows, df = _panel(spark, 4, 5)
    same = M.masked_panel(df, "e", "t", FEATS).collect()
    assert all((r.a, r.b) == (r.m_a, r.m_b) for r in same) and len(same) == len(rows)
    late = M.masked_panel(df, "e", "t", FEATS, lambda d, e, t, feats, after: d.withColumns(
        {f"m_{c}": F.when(F.col(t) <= after, F.lit(7.0)) for c in feats}), after=2).collect()
    assert all((r.m_a is None) == (r.a is None or r.t > 2) and (r.m_a is None or r.m_a == r.a) for r in late)
    with pytest.raises(ValueError):
        M.masked_panel(df, "e", "t", FEATS, lambda d, *_: d)


def test_feature_selection_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=50), rng.normal(size=50)
    x = np.column_stack([a, b, 2 * a + 0.01 * b, np.full(50, 3.0), rng.normal(size=50), -b])
    cols = ["p", "q", "r", "s", "t_skewness", "u"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    got = MD.select_features(df, cols, 0.95, ("_skewness",))
    assert [d for _, _, d in got] == ["kept", "kept", "correlated", "constant", "suffix", "correlated"]
    assert np.allclose([v for _, v, _ in got], x.var(axis=0))
