"""As-of stay attribution vs brute force, across range boundaries."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from wardflow.operators import asof as A
from wardflow.operators import ranks
from wardflow.operators.ranks import running

BASE = dt.datetime(2020, 1, 1)


def _fixture(seed):
    rnd = random.Random(seed)
    stays, events = [], []
    sid = 0
    for e in range(8):
        t = BASE + dt.timedelta(days=rnd.randint(0, 20))
        for _ in range(rnd.randint(1, 6)):
            sid += 1
            out = None if rnd.random() < 0.2 else t + dt.timedelta(days=rnd.randint(0, 15))
            stays.append((e, sid, t, out, rnd.choice(["a", "b", "c"])))
            t = t + dt.timedelta(days=rnd.randint(-3, 12))     # overlapping stays allowed
        for i in range(rnd.randint(0, 12)):
            when = None if rnd.random() < 0.05 else BASE + dt.timedelta(days=rnd.randint(-5, 120),
                                                                        hours=rnd.randint(0, 23))
            events.append((e, i, when))
    events.append((99, 0, BASE))   # entity without stays
    return stays, events


def _brute(stays, events, order_key):
    by_e = {}
    for s in stays:
        by_e.setdefault(s[0], []).append(s)
    far = dt.datetime(2050, 12, 31)
    eff = {}
    for e, ss in by_e.items():
        mx = max(s[3] or far for s in ss)
        for s in ss:
            eff[s[1]] = far if (s[3] is None or s[3] == mx) else s[3]
    out = {}
    for e, i, t in events:
        cands = [s for s in by_e.get(e, []) if t is not None and eff[s[1]] >= t]
        out[(e, i)] = min(cands, key=order_key)[1] if cands else None
    return out


def _with_partitions(spark, parts):
    """``running`` over exactly ``parts`` ranges."""
    def call(*args):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            return running(*args)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return call


@pytest.mark.parametrize("parts,seed", [("1", 11), ("3", 12), ("9", 13)])
def test_asof_matches_brute_force(spark, parts, seed, monkeypatch):
    monkeypatch.setattr(A, "running", _with_partitions(spark, parts))
    stays, events = _fixture(seed)
    sdf = spark.createDataFrame(stays, "e long, sid long, tin timestamp, tout timestamp, prio string")
    edf = spark.createDataFrame(events, "e long, i long, t timestamp")
    st = A.effective_end(sdf, "e", "tout")
    for order, key in [(["tin", "sid"], lambda s: (s[2], s[1])), (["prio", "tin", "sid"], lambda s: (s[4], s[2], s[1]))]:
        got = A.asof_first_ending_after(edf, st, "e", "t", order, "eff_out", ["sid"])
        res = {(r.e, r.i): (r.stay.sid if r.stay else None) for r in got.collect()}
        assert res == _brute(stays, events, key)


def test_asof_partition_independent(spark):
    stays, events = _fixture(21)
    sdf = spark.createDataFrame(stays, "e long, sid long, tin timestamp, tout timestamp, prio string")
    edf = spark.createDataFrame(events, "e long, i long, t timestamp")
    res = []
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = A.asof_first_ending_after(edf, A.effective_end(sdf, "e", "tout"), "e", "t", ["tin", "sid"],
                                        "eff_out", ["sid"])
        res.append(sorted((r.e, r.i, r.stay.sid if r.stay else -1) for r in got.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert res[0] == res[1]


def test_one_entity_on_one_day_is_split_and_top1_is_partial(spark, monkeypatch):
    """An entity with most rows, all on one day and many at one instant: no
    range holds more than twice the mean, and keep-first runs a partial
    (map-side) min_by."""
    from pyspark.sql import functions as F

    from wardflow.operators import relational as R
    hot = [(0, i, BASE + dt.timedelta(days=3, seconds=0 if i % 2 else i)) for i in range(1500)]
    cold = [(e, i, BASE + dt.timedelta(hours=31 * i + e)) for e in range(1, 11) for i in range(20)]
    events = spark.createDataFrame(hot + cold, "e long, i long, t timestamp")
    stays = spark.createDataFrame([(e, s, BASE + dt.timedelta(days=10 * s), BASE + dt.timedelta(days=10 * s + 9))
                                   for e in range(11) for s in range(15)], "e long, sid long, tin timestamp, tout timestamp")
    written = []
    plain = ranks.sorted_ranges
    monkeypatch.setattr(ranks, "sorted_ranges", lambda *a, **k: written.append(plain(*a, **k)) or written[-1])
    monkeypatch.setattr(A, "running", _with_partitions(spark, "8"))
    out = A.asof_first_ending_after(events, A.effective_end(stays, "e", "tout"), "e", "t", ["tin", "sid"], "eff_out", ["sid"])
    got = {(r.e, r.i): r.stay.sid for r in out.collect()}
    assert got == {(e, i): min(s for s in range(15) if BASE + dt.timedelta(days=10 * s + 9) >= t or s == 14) for e, i, t in hot + cold}
    sizes = [r[0] for r in written[-1].groupBy("_part").count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    assert len(written[-1].filter("_kind = 1 AND e = 0").select("_part").distinct().collect()) >= 6
    top = R.first_per_key(events, ["e"], [("t", True), ("i", False)], ["i"])
    assert "partial_min_by" in top._jdf.queryExecution().executedPlan().toString()
