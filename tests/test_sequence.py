"""Sequence operators against brute-force Python on random series."""

from __future__ import annotations

import random

import pytest

from conftest import rows
from wardflow.operators import sequence as S


def _series(seed, n_entities=6, max_len=12, p_null=0.45):
    rnd = random.Random(seed)
    data = []
    for e in range(n_entities):
        for t in range(rnd.randint(1, max_len)):
            v = None if rnd.random() < p_null else round(rnd.uniform(0, 100), 3)
            data.append((e, t, v))
    return data


def _by_entity(data):
    out = {}
    for e, t, v in data:
        out.setdefault(e, []).append((t, v))
    return {e: [v for _t, v in sorted(x)] for e, x in out.items()}


def _interp_ref(vals, edges, exclude_self=False):
    res = []
    for i, v in enumerate(vals):
        if v is not None and not exclude_self:
            res.append(v)
            continue
        if exclude_self and v is None:
            res.append(None)
            continue
        p = next(((j, vals[j]) for j in range(i - 1, -1, -1) if vals[j] is not None), None)
        n = next(((j, vals[j]) for j in range(i + 1, len(vals)) if vals[j] is not None), None)
        if p and n:
            res.append(p[1] + (n[1] - p[1]) * (i - p[0]) / (n[0] - p[0]))
        elif edges == "both":
            res.append(p[1] if p else (n[1] if n else None))
        elif edges == "forward":
            res.append(p[1] if p else None)
        else:
            res.append(None)
    return res


def _close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


@pytest.mark.parametrize("edges", ["both", "inside", "forward"])
def test_interpolate_matches_brute_force(spark, edges):
    data = _series(1)
    df = spark.createDataFrame(data, "e long, t long, x double")
    got = _by_entity([(r.e, r.t, r.x) for r in S.interpolate(df, "e", "t", ["x"], edges).collect()])
    for e, vals in _by_entity(data).items():
        ref = _interp_ref(vals, edges)
        assert all(_close(a, b) for a, b in zip(got[e], ref)), (e, got[e], ref)


def test_ffill_bfill_and_observed_unchanged(spark):
    data = _series(2)
    df = spark.createDataFrame(data, "e long, t long, x double")
    got = _by_entity([(r.e, r.t, r.x) for r in S.ffill_bfill(df, "e", "t", ["x"]).collect()])
    for e, vals in _by_entity(data).items():
        f = []
        last = None
        for v in vals:
            last = v if v is not None else last
            f.append(last)
        first_obs = next((v for v in vals if v is not None), None)
        ref = [x if x is not None else first_obs for x in f]
        assert got[e] == ref
        assert all(g == v for g, v in zip(got[e], vals) if v is not None)


def test_loo_estimate(spark):
    data = _series(3, p_null=0.3)
    df = spark.createDataFrame(data, "e long, t long, x double")
    out = S.loo_estimate(df, "e", "t", "x")
    got = _by_entity([(r.e, r.t, r.estimate) for r in out.collect()])
    for e, vals in _by_entity(data).items():
        ref = _interp_ref(vals, "both", exclude_self=True)
        assert all(_close(a, b) for a, b in zip(got[e], ref)), (e, got[e], ref)


def test_runs_and_positions(spark):
    data = _series(4)
    df = spark.createDataFrame(data, "e long, t long, x double")
    from pyspark.sql import functions as F
    runs = rows(S.run_lengths(df, "e", "t", F.col("x").isNull()).select("e", "flag", "length"))
    ref = []
    for e, vals in _by_entity(data).items():
        flags = [v is None for v in vals]
        i = 0
        while i < len(flags):
            j = i
            while j < len(flags) and flags[j] == flags[i]:
                j += 1
            ref.append((e, flags[i], j - i))
            i = j
    assert runs == sorted(ref)
    pos = _by_entity([(r.e, r.t, r.p) for r in S.position_in_run(df, "e", "t", "x", "p").collect()])
    for e, vals in _by_entity(data).items():
        k, ref_pos = 0, []
        for v in vals:
            k = k + 1 if v is None else 0
            ref_pos.append(k)
        assert pos[e] == ref_pos


def _rate_ref(ts_vals):
    ts = [t for t, _ in ts_vals]
    reads = [(t, v) for t, v in ts_vals if v is not None and v != 0]
    out = []
    tfirst = ts[0]
    for t in ts:
        nxt = next(((tk, vk) for tk, vk in reads if tk >= t), None)
        if nxt is None:
            out.append(None)
            continue
        prev = [tk for tk, _ in reads if tk < nxt[0]]
        if prev:
            out.append(nxt[1] / (nxt[0] - prev[-1]))
        elif nxt[0] == tfirst:
            out.append(nxt[1])
        else:
            out.append(nxt[1] / (nxt[0] - tfirst))
    held, res = None, []
    for r in out:
        held = r if r is not None else held
        res.append(r if r is not None else held)
    return res


def test_volume_rate(spark):
    rnd = random.Random(5)
    data = []
    for e in range(5):
        for t in range(rnd.randint(2, 10)):
            x = rnd.random()
            data.append((e, t, None if x < 0.4 else (0.0 if x < 0.5 else round(rnd.uniform(1, 50), 2))))
    df = spark.createDataFrame(data, "e long, t long, v double")
    got = {}
    for r in S.volume_rate(df, "e", "t", "v", "rate").collect():
        got.setdefault(r.e, []).append((r.t, r.rate))
    for e in got:
        src = sorted((t, v) for ee, t, v in data if ee == e)
        ref = _rate_ref(src)
        assert all(_close(a, b) for (_t, a), b in zip(sorted(got[e]), ref)), (e, sorted(got[e]), ref)


def test_sliding_windows_complete_only(spark):
    df = spark.createDataFrame([(1, t, None if t == 3 else float(t)) for t in range(8)], "e long, t long, x double")
    starts = sorted(r.start for r in S.sliding_windows(df, "e", "t", ["x"], 3).collect())
    assert starts == [0, 4, 5]       # windows touching t=3 or running off the end are dropped
