"""Streaming hourly bins agree with the batch computation on the same rows."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from wardflow.streaming import hourly as H


def test_stream_hourly_counts_match_batch(spark):
    src = tempfile.mkdtemp(prefix="wf-stream-src-")
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    # land the table as several files, as a feed would
    ev.repartition(4).write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    stream = H.measurement_stream(spark, os.path.join(src, "batch1"))
    q = (H.hourly_bins(stream, delay="10000 hours")
         .writeStream.outputMode("complete").format("memory").queryName("hourly_bins_test")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="wf-stream-ck-")).start())
    q.processAllAvailable()
    q.stop()
    got = {(r.user_id, r.event_type, r.window.start.replace(tzinfo=None)): r.n
           for r in spark.sql("SELECT * FROM hourly_bins_test").collect()}
    batch = (ev.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour"), "user_id", "event_type")
             .agg(F.count(F.lit(1)).alias("n")).collect())
    ref = {(r.user_id, r.event_type, r.window.start.replace(tzinfo=None)): r.n for r in batch}
    assert got == ref and len(got) > 0
