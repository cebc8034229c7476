"""Hourly reduction of a measurement stream (extension; the batch library
covers the inventory's operators).

A file-source stream of measurement rows is binned into absolute event-time
hours per (entity, feature) with a watermark, so state for an hour is
dropped once the watermark passes it and late rows beyond the allowed delay
are ignored.  The median is approximate in streaming (``percentile_approx``
keeps a bounded sketch per group in the state store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASUREMENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def measurement_stream(spark: SparkSession, directory: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Parquet file source over a landing folder (explicit schema)."""
    return (spark.readStream.schema(MEASUREMENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(directory))


def hourly_bins(stream: DataFrame, entity: str = "user_id", feature: str = "event_type",
                time: str = "ts", value: str = "value", delay: str = "2 hours") -> DataFrame:
    """``(window, entity, feature, n, median_approx, mean)`` per event-time
    hour; rows later than ``delay`` behind the watermark are dropped."""
    ts = F.col(time).cast("timestamp")
    s = stream.withColumn("_ts", ts).withWatermark("_ts", delay)
    return (s.groupBy(F.window("_ts", "1 hour"), entity, feature)
            .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, 0.5, 10000).alias("median_approx"),
                 F.avg(value).alias("mean")))


def start_hourly(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 trigger_seconds: int = 60):
    """Append hourly bins as Parquet once each hour is final (watermark)."""
    q = (hourly_bins(measurement_stream(spark, source_dir))
         .select(F.col("window.start").alias("hour_start"), "user_id", "event_type", "n", "median_approx", "mean")
         .writeStream.outputMode("append").format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
         .trigger(processingTime=f"{trigger_seconds} seconds").start())
    return q
