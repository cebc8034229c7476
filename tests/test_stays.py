"""Stay-level operators on hand-made census-like rows (FIXTURES F1/F7/F8
edge cases: open stay, two stays of one encounter, id with letters,
unparsable score text, tie on the match score)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import scalar as SC
from wardflow.operators import asof as A
from wardflow.operators import relational as R

D0 = dt.datetime(2024, 1, 1)


def test_effective_end_open_and_last_stays(spark):
    stays = spark.createDataFrame([
        ("E1", 1, D0, D0 + dt.timedelta(days=2)),
        ("E1", 2, D0 + dt.timedelta(days=3), D0 + dt.timedelta(days=5)),   # latest end -> far future
        ("E2", 3, D0, None),                                                # open stay -> far future
        ("E2", 4, D0 - dt.timedelta(days=9), D0 - dt.timedelta(days=8)),
    ], "enc string, sid long, tin timestamp, tout timestamp")
    got = {r.sid: r.eff_out for r in A.effective_end(stays, "enc", "tout").collect()}
    far = dt.datetime(2050, 12, 31)
    assert got == {1: D0 + dt.timedelta(days=2), 2: far, 3: far, 4: D0 - dt.timedelta(days=8)}


def test_event_before_first_admission_attaches_to_first_stay(spark):
    stays = A.effective_end(spark.createDataFrame(
        [("E1", 1, D0, D0 + dt.timedelta(days=1)), ("E1", 2, D0 + dt.timedelta(days=4), D0 + dt.timedelta(days=6))],
        "enc string, sid long, tin timestamp, tout timestamp"), "enc", "tout")
    ev = spark.createDataFrame([("E1", "before", D0 - dt.timedelta(days=30)),
                                ("E1", "gap", D0 + dt.timedelta(days=2)),
                                ("E3", "no_stay", D0)], "enc string, tag string, t timestamp")
    got = {r.tag: (r.stay.sid if r.stay else None)
           for r in A.asof_first_ending_after(ev, stays, "enc", "t", ["tin", "sid"], "eff_out", ["sid"]).collect()}
    assert got == {"before": 1, "gap": 2, "no_stay": None}


def test_id_digits_percent_and_safe_cast(spark):
    df = spark.createDataFrame([("AB-00123x", "Mortalité prédite : 12,5%", "3.5"),
                                ("77", "non calculable", "abc"), (None, None, None)],
                               "raw string, pct string, num string")
    got = df.select(SC.digits_only("raw").alias("d"), SC.parse_percent("pct").alias("p"),
                    SC.safe_double("num").alias("x")).collect()
    assert [tuple(r) for r in got] == [("00123", 0.125, 3.5), ("77", None, None), (None, None, None)]


def test_best_registry_match_with_tie(spark):
    reg = spark.createDataFrame([(1, 0.9, D0, 1), (1, 0.9, D0 - dt.timedelta(days=1), 1), (1, 0.95, D0, 0),
                                 (2, 0.5, D0, 1)], "nip long, score double, d timestamp, upper int")
    best = R.first_per_key(reg.filter(F.col("upper") == 1), ["nip"], [("score", True), ("d", False)], ["score", "d"])
    got = {r.nip: (r.score, r.d) for r in best.collect()}
    # upper = 0 rows are ignored; a tie on the score goes to the earliest date
    assert got == {1: (0.9, D0 - dt.timedelta(days=1)), 2: (0.5, D0)}
