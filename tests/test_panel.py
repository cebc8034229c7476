"""Panel builders on hand-made fixtures (edge rows from FIXTURES F2/F5/F12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from wardflow.functions.dictionary import literal_table
from wardflow.operators import panel as P

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def ts(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_hour_bins_truncate_toward_zero_and_cut_below_minus_one(spark):
    meas = spark.createDataFrame(
        [(1, ts(0), "hr", 80.0), (1, ts(-30), "hr", 81.0), (1, ts(-60), "hr", 82.0), (1, ts(-90), "hr", 83.0),
         (1, ts(61), "hr", 70.0), (1, ts(62), "hr", 72.0), (2, ts(5), "hr", 60.0)],
        "e long, t timestamp, f string, v double")
    origin = spark.createDataFrame([(1, T0)], "e long, origin timestamp")  # entity 2 outside the cohort
    bounds = literal_table(spark, [("hr", "hr", 0.0, 300.0)], "f string, feature string, lo_b double, hi_b double")
    out = rows(P.trimmed_hourly_median(meas, origin, bounds, "e", "t", "f", "v"))
    # -0.5 h -> bin 0 (with the 0 h reading), -1.0 h -> bin -1, -1.5 h dropped,
    # two readings in hour 1 -> their median; entity 2 not in cohort
    assert out == [(1, "hr", -1, 82.0), (1, "hr", 0, 80.5), (1, "hr", 1, 71.0)]


def test_bounds_range_sigma_and_unknown_range(spark):
    vals = [("a", float(x)) for x in [10, 11, 12, 13, 14, 15, 500]] + [("b", 5.0), ("b", 50.0)] + \
           [("c", 1.0), ("c", 2.0), ("c", 3.0)]
    meas = spark.createDataFrame(vals, "f string, v double")
    ranges = literal_table(spark, [("a", "a", 0.0, 100.0, False), ("b", "b", 0.0, 30.0, True),
                                   ("c", "c", None, None, False)],
                           "f string, feature string, lo double, hi double, range_only boolean")
    b = {r["f"]: (r["lo_b"], r["hi_b"]) for r in P.feature_bounds(meas, ranges, "f", "v").collect()}
    import statistics as st
    inr = [10, 11, 12, 13, 14, 15]   # 500 is outside [0, 100]: excluded from the moments
    m, s = st.mean(inr), st.stdev(inr)
    assert abs(b["a"][0] - max(0, m - 3 * s)) < 1e-9 and abs(b["a"][1] - min(100, m + 3 * s)) < 1e-9
    assert b["b"] == (0.0, 30.0)      # range only
    m, s = 2.0, 1.0
    assert abs(b["c"][0] - (m - 3 * s)) < 1e-9 and abs(b["c"][1] - (m + 3 * s)) < 1e-9


def test_dense_grid_skips_negative_only_entities(spark):
    bins = spark.createDataFrame([(1, -1), (1, 3), (2, -1), (3, 0)], "e long, t long")
    out = rows(P.dense_grid(bins, "e", "t", 0))
    assert out == [(1, 0), (1, 1), (1, 2), (1, 3), (3, 0)]


def test_densify_keeps_observed_and_counts(spark):
    panel = spark.createDataFrame([(1, 0, 1.0), (1, 4, 2.0), (2, 2, 3.0)], "e long, t long, x double")
    d = P.densify(panel, "e", "t")
    got = {(r.e, r.t): r.x for r in d.collect()}
    assert len([k for k in got if k[0] == 1]) == 5 and len([k for k in got if k[0] == 2]) == 3
    assert got[(1, 4)] == 2.0 and got[(1, 2)] is None


def test_reorigin_and_trim(spark):
    panel = spark.createDataFrame([(1, 0, None), (1, 1, None), (1, 2, 5.0), (1, 3, None), (1, 4, 6.0), (1, 5, None),
                                   (2, 0, None)], "e long, t long, x double")
    r = rows(P.reorigin(panel, "e", "t", F.col("x").isNotNull()))
    assert [t for _e, t, _x in r] == [0, 1, 2, 3] and all(e == 1 for e, *_ in r)
    kb = rows(P.reorigin(panel, "e", "t", F.col("x").isNotNull(), keep_before=True))
    assert [t for _e, t, _x in kb] == [-2, -1, 0, 1, 2, 3]
    tr = rows(P.trim_trailing(panel, "e", "t", F.col("x").isNotNull()))
    assert [t for _e, t, _x in tr] == [0, 1, 2, 3, 4]


def test_classwise_reduce_first_keeps_null_and_sum_defaults_zero(spark):
    df = spark.createDataFrame(
        [(1, 0, "a", 1.0, None, ts(1)), (1, 0, "a", 3.0, "x", ts(2)), (1, 0, "s", None, None, ts(3)),
         (1, 0, "t", None, None, ts(0)), (1, 0, "t", None, "late", ts(5)), (1, 1, "a", 2.0, None, ts(60))],
        "e long, h long, f string, v double, txt string, t timestamp")
    out = P.classwise_reduce(df, ["e", "h"], "f", "v", "txt", "t",
                             [("a", "num", "numeric"), ("s", "vol", "summed"), ("t", "txt", "string")])
    got = {r.h: (r.num, r.vol, r.txt) for r in out.collect()}
    assert got[0] == (2.0, 0.0, None)     # first text of 't' is null and stays null
    assert got[1] == (2.0, 0.0, None)     # no 's' rows in the hour -> 0, no 't' rows -> null


def test_no_window_holds_the_grid_of_reorigin_any(spark):
    from conftest import SMALL

    from wardflow.plans import q_panel as QP
    plan = QP.reorigin_any(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window ")      # what stands higher comes first
