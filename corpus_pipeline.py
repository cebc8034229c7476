"""Corpus pipeline: quality filter, line dedup, near-duplicate removal,
benchmark decontamination, mixing to source weights.

Each stage works on all documents its predecessor kept, which are written as
Parquet into the shared folder and read again.  All but the last return the
columns of ``documents`` as they came (any others too); the last adds
``copy_no`` and ``shuffle_key``.  Null, empty, very long and repeated rows are
treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.decontaminate import decontaminate
from wardflow.llm.jaccard_join import drop_near_duplicates
from wardflow.llm.line_dedup import line_dedup
from wardflow.llm.mixing import poisson_mix
from wardflow.llm.quality import keep_quality
from wardflow.llm.shared import NOT_SPACE, free_name, materialise, prepare
from wardflow.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    return keep_quality(docs, read_table(prepare(spark), sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document of which no
    word is left goes, any other stays."""
    prepare(spark)
    lines, deleted = (free_name(c, docs.columns) for c in ("n_lines", "deleted"))
    out = line_dedup(docs, n_lines=lines, deleted=deleted)
    out = out.filter((F.size(deleted) == 0) | F.col("text").rlike(NOT_SPACE))
    cut = F.size(deleted) > 0
    return out.select(*[F.when(cut, F.length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    prepare(spark)
    return drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate(docs, read_table(prepare(spark), sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to their source's rate and shuffled."""
    prepare(spark)
    return poisson_mix(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("poisson_mixing", mixing_stage),
]

#: a fitted classifier and MinHash can't be stated in SQL; tests/llm/test_pipeline.py compares the stages with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
