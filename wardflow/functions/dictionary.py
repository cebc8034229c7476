"""Fixed dimension tables: feature dictionary, clinical ranges, code maps.

These are small literal tables (their size is fixed by this file), so they
are safe to broadcast into any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: plausible clinical range per feature (lo, hi), inclusive --
CLINICAL_RANGES = [
    ("temp", 30.0, 43.0),
    ("pam", 0.0, 250.0),
    ("pas", 0.0, 350.0),
    ("pad", 0.0, 200.0),
    ("heart_rate", 0.0, 300.0),
    ("spo2", 70.0, 100.0),
    ("fr", 1.0, 60.0),
    ("fio2", 20.0, 101.0),
    ("pep", 0.0, 30.0),
]
# --- fixed values: features trimmed by their range only (no sigma bounds) ---
RANGE_ONLY_FEATURES = ("pep", "fio2")
# --- fixed values: suffixes removed to find the range of a measured variant --
RANGE_SUFFIXES = ("_non_invasive", "_invasive")

# Feature dictionary for the driver's ``events`` table (our role mapping):
# source item -> (feature name, reducer class, value column).
# Reducer classes: numeric -> hourly median, summed -> hourly sum (all-null
# hour = 0), string -> first value in chart order (nulls kept).
EVENT_FEATURES = [
    ("view", "heart_rate", "numeric", "value"),
    ("click", "pam_invasive", "numeric", "value"),
    ("purchase", "pam_non_invasive", "numeric", "value"),
    ("error", "fio2", "numeric", "value"),
    ("signup", "urine_output", "summed", "value"),
    ("error", "mode_vent", "string", "props"),
]



def range_key(feature: str) -> str:
    for suffix in RANGE_SUFFIXES:
        feature = feature.replace(suffix, "")
    return feature


def range_table(spark: SparkSession) -> DataFrame:
    """``(range_feature, lo, hi, range_only)``."""
    rows = [(f, lo, hi, f in RANGE_ONLY_FEATURES) for f, lo, hi in CLINICAL_RANGES]
    schema = "range_feature string, lo double, hi double, range_only boolean"
    return literal_table(spark, rows, schema)


def event_feature_table(spark: SparkSession) -> DataFrame:
    """``(event_type, feature, reducer, value_column, range_feature)``."""
    rows = [(src, feat, cls, col, range_key(feat)) for src, feat, cls, col in EVENT_FEATURES]
    schema = ("event_type string, feature string, reducer string, value_column string, "
              "range_feature string")
    return literal_table(spark, rows, schema)


def numeric_feature_ranges(spark: SparkSession) -> DataFrame:
    """Numeric/summed features of the events dictionary with their range
    (left join: a feature without a known range keeps null bounds)."""
    feats = event_feature_table(spark).filter(F.col("value_column") == "value")
    return (feats.join(F.broadcast(range_table(spark)), "range_feature", "left")
            .select("event_type", "feature", "lo", "hi",
                    F.coalesce("range_only", F.lit(False)).alias("range_only")))


def _sql_lit(v, dtype: str) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS {dtype})"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small fixed table as a SQL ``VALUES`` relation: a JVM-side local scan
    with exact size statistics (no Python-backed RDD), safe to broadcast."""
    cols = [c.strip().split() for c in schema.split(",")]
    names, types = [c[0] for c in cols], [c[1] for c in cols]
    body = ", ".join("(" + ", ".join(_sql_lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    sel = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {sel} FROM VALUES {body} AS t({', '.join(names)})")
