"""Readers/writers on temporary folders, and the driver contract."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import duckdb
import pytest

from conftest import MEDIUM, SMALL
from wardflow.sources import io as IO
from wardflow.sources.tables import TABLES


def test_feature_files_and_partitioned_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="wf-src-")
    a = spark.createDataFrame([(1, 1.0, "x")], "e long, valueNumber double, valueString string")
    b = spark.createDataFrame([(2, 2.0)], "e long, valueNumber double")      # totals: no text value
    a.write.parquet(os.path.join(d, "files", "heart_rate.parquet"))
    b.write.parquet(os.path.join(d, "files", "urine_output.parquet"))
    long = IO.read_feature_files(spark, os.path.join(d, "files", "*"))
    got = sorted((r.e, r.feature, r.valueString) for r in long.collect())
    assert got == [(1, "heart_rate", "x"), (2, "urine_output", None)]
    IO.write_parquet(long, os.path.join(d, "by_feature"), partition_by=["feature"])
    back = IO.read_partitioned(spark, os.path.join(d, "by_feature")).filter("feature = 'heart_rate'")
    assert "PartitionFilters: [isnotnull(feature" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 1


def test_delimited_permissive_with_quarantine(spark):
    d = tempfile.mkdtemp(prefix="wf-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("id;score;when\n1;2.5;2024-01-01\n2;abc;2024-01-02\n3;4.0\n")
    df = IO.read_delimited(spark, p, "id int, score double, when date").cache()
    got = sorted((r.id, r.score, r._corrupt_record is not None) for r in df.collect())
    assert got[0] == (1, 2.5, False) and got[1][1] is None and got[1][2] is True
    out = os.path.join(d, "out")
    IO.write_delimited(df.select("id", "score"), out, sep=";")
    assert any(n.endswith(".csv") for n in os.listdir(out))


def test_json_config_to_table(spark):
    d = tempfile.mkdtemp(prefix="wf-json-")
    p = os.path.join(d, "ranges.json")
    with open(p, "w") as f:
        json.dump({"temp": {"range": [30, 43]}, "spo2": {"range": [70, 100]}}, f, indent=2)
    t = IO.read_json_config(spark, p, "struct<range: array<double>>")
    got = sorted((r.name, list(r.range)) for r in t.collect())
    assert got == [("spo2", [70.0, 100.0]), ("temp", [30.0, 43.0])]


def test_dated_path_and_cut_lineage(spark):
    assert IO.dated_path("/x", "raw", dt.date(2024, 5, 1)) == "/x/raw_2024-05-01"
    df = spark.range(10)
    assert IO.cut_lineage(df).count() == 10
    assert IO.cut_lineage(df, "table", "t10").count() == 10


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 90
    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["user_id", "feature", "hour", "median_value"]


ORACLE_SAMPLE = ["hourly_median", "hourly_panel_classwise", "interp_both", "volume_rate", "asof_next_stay",
                 "missing_runs", "roc_auc_by_group", "scenario_errors", "stay_rollup", "series_features"]


@pytest.mark.parametrize("name", ORACLE_SAMPLE if not os.environ.get("WARDFLOW_ALL_ORACLES")
                         else sorted(__import__("__spark_entry__").oracle_sql()))
def test_oracle_small(spark, name):
    """Spark query vs its DuckDB oracle on the smallest tables."""
    import __spark_entry__ as E
    sf = SMALL if os.path.isdir(SMALL) else MEDIUM
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sdf = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(cols)

    def norm(v):
        if isinstance(v, float):
            return round(v, 5)
        return v.isoformat() if hasattr(v, "isoformat") else v

    def canon(names, recs):
        idx = sorted(range(len(names)), key=lambda i: names[i])
        return sorted((tuple(norm(r[i]) for i in idx) for r in recs), key=repr)

    assert canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == canon(cols, res.fetchall())


def test_flagship_plan_prunes_pushes_and_combines(spark):
    """The flagship reads only the needed columns, pushes the admission
    filter into the scan and combines the median map-side."""
    import __spark_entry__ as E
    plan = E.queries()["hourly_median"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "EqualTo(event_type,signup)" in plan
    assert "partial_percentile" in plan and "CartesianProduct" not in plan


def test_size_for_input(spark):
    from wardflow.session import size_for_input
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        n = size_for_input(spark, 100 * (1 << 40))
        assert n == 100 * (1 << 40) // (256 << 20) + 1 and spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
        assert size_for_input(spark, 10 << 20) == 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
