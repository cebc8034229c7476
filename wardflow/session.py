"""Spark session construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that every session of the library relies on.  Timestamps are
# compared as UTC wall-clock values, AQE re-plans joins (broadcast conversion
# from measured sizes, skew-join splitting, partition coalescing).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "wardflow", driver_memory: str = "8g") -> SparkSession:
    """Local/test session; on a cluster use the cluster's own builder and
    call :func:`configure` on it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume and make the
    package importable by the executors' Python workers.  The checkpoint
    folder is looked up only by the operators that write to it."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Zip this package once per Spark application and add it with
    ``addPyFile`` (what ``--py-files`` does at submit time), so functions
    running in Python workers (``mapInPandas``) can import it on every
    executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="wardflow-pyfiles-"), "wardflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> int:
    """Cluster sizing from the input volume: scan splits and shuffle
    partitions of about ``target_partition_bytes`` (fits executor memory
    with room for sort/aggregation buffers), AQE coalescing towards the same
    advisory size, skew-join splitting of partitions 5x the median and above
    the target.  Returns the shuffle partition count."""
    n = max(8, input_bytes // target_partition_bytes + 1)
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The setting is read from the session (``spark.checkpoint.dir`` or the
    context's directory).  When nothing is configured, a scratch folder is
    created in local mode only (tests on one machine); elsewhere a
    machine-local folder would be invisible to the other executors, so this
    raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="wardflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
