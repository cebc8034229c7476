"""Driver tables and the roles they play.

The library works on any ``(entity, time, feature, value)`` measurement table
plus a stay table.  The driver's synthetic tables are mapped by role:

* ``events``  -> measurements: ``user_id`` = entity, ``event_type`` = feature,
  ``value`` = numeric value, ``props`` = text value, ``ts`` = chart time.
  Admission time of a user = first ``signup`` event.
* ``orders``  -> stays: ``o_custkey`` = entity, ``o_orderkey`` = stay id,
  ``o_orderdate`` = in time; out time = next stay's in time (open when last).
* ``lineitem`` -> charted rows attached to stays (``l_shipdate`` = chart time).
* ``documents`` / ``labels`` -> free text and binary outcome.
* ``embeddings`` -> per-entity vectors for MLlib.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; column pruning and filter pushdown
    are left to Catalyst (select/filter after this call reach the scan)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Measurement role of the ``events`` table.
ENTITY = "user_id"
TIME = "ts"
FEATURE = "event_type"
VALUE = "value"
TEXT_VALUE = "props"
ADMISSION_FEATURE = "signup"


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long measurement table ``(user_id, ts, event_type, value, props)``."""
    return read_table(spark, sf_dir, "events").select(ENTITY, TIME, FEATURE, VALUE, TEXT_VALUE)
