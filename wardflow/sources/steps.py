"""Resumable steps: what a finished step wrote is used again.

A run is named by its input; its steps write into one folder below the shared
folder named by ``spark.checkpoint.dir``.  When a step's work has ended, a
one-row table beside it says so, and only then does the step count as
complete: a run killed between or within steps, started again with the same
name, skips the complete ones and repeats the one it was in.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import ensure_checkpoint_dir


def fingerprint(table: DataFrame) -> str:
    """Names a table by its files: their paths, sizes and times of change, in
    one aggregate over the scan's metadata."""
    file = [F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_modification_time")]
    files = table.select(*[c.alias(f"c{i}") for i, c in enumerate(file)]).distinct()
    r = files.agg(F.bit_xor(F.xxhash64("c0", "c1", "c2")).alias("h"), F.count(F.lit(1)).alias("n")).first()
    return f"{(r['h'] or 0) & ((1 << 64) - 1):016x}-{r['n']}"


class Steps:
    """Steps of the run ``name`` (any text that identifies job and input, for
    the latter see :func:`fingerprint`).
    The folder is the cluster's checkpoint folder, or ``folder``, to be given
    where a run shall be resumed by another application."""

    def __init__(self, spark: SparkSession, name: str, folder: str | None = None):
        self.spark = spark
        run = re.sub(r"[^A-Za-z0-9]+", "-", name).strip("-")[-60:] + "-" + hashlib.sha256(name.encode()).hexdigest()[:12]
        self.folder = os.path.join(folder or ensure_checkpoint_dir(spark), "steps", run)

    def path(self, step: str) -> str:
        return os.path.join(self.folder, step)

    def _mark(self, step: str) -> str:
        return os.path.join(self.folder, "complete", step)

    def complete(self, step: str) -> bool:
        try:
            return self.spark.read.schema("step string").parquet(self._mark(step)).count() == 1
        except AnalysisException:                        # no such table
            return False

    def once(self, step: str, work: Callable[[], None]) -> bool:
        """Do ``work`` unless the step is complete; tells whether it was done."""
        if self.complete(step):
            return False
        work()
        self.spark.createDataFrame([(step,)], "step string").coalesce(1).write.mode("overwrite").parquet(self._mark(step))
        return True

    def table(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step, made and written only if it is not there."""
        self.once(step, lambda: make().write.mode("overwrite").parquet(self.path(step)))
        return self.spark.read.parquet(self.path(step))
