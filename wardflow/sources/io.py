"""Readers and writers: Parquet (single file, directory, partitioned),
delimited text with tolerant parsing, JSON configuration, JDBC, dated sinks
and lineage cuts.

Everything is a plain DataFrame reader/writer call; filters and column
selections applied after a read reach the scan (Parquet pushdown, JDBC
predicate pushdown).
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import ensure_checkpoint_dir


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet scan (A4); an explicit schema avoids footer inference."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_feature_files(spark: SparkSession, directory: str, feature_col: str = "feature",
                       schema: T.StructType | str | None = None) -> DataFrame:
    """A directory of one-file-per-feature Parquet files read as ONE long
    table (A5); the feature name is the file stem, taken from the scan's
    file metadata column (no driver-side file loop).  Files missing a
    column (e.g. output totals without a text value) are read with the
    union schema: the column is null there (M3)."""
    r = spark.read.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(directory)
    path = F.col("_metadata.file_path")
    # <feature>.parquet as a single file, or as a folder of part files
    dir_stem = F.regexp_extract(path, r"([^/]+?)(?:\.parquet)?/part-[^/]+$", 1)
    file_stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)
    return df.withColumn(feature_col, F.when(dir_stem != "", dir_stem).otherwise(file_stem))


def read_partitioned(spark: SparkSession, directory: str) -> DataFrame:
    """A ``partitionBy('feature')`` table: filters on the partition column
    prune directories (A5 as partition pruning)."""
    return spark.read.parquet(directory)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
                   header: bool = True, corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """Delimited text with an explicit schema (A6/A7): unparsable values
    become null (PERMISSIVE); the raw line of a malformed row is kept in
    ``corrupt_col`` for a quarantine output (A15)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if corrupt_col:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    r = (spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
         .schema(schema))
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.csv(path)


def read_json_config(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """A JSON object ``{name: {...}}`` (feature dictionary, range table) as a
    table ``(name, <value fields>)`` (A8): the whole file is read as text,
    parsed as ``map<string, value_schema>`` and exploded."""
    txt = spark.read.text(path, wholetext=True)
    parsed = txt.select(F.explode(F.from_json("value", f"map<string, {value_schema}>")).alias("name", "v"))
    return parsed.select("name", "v.*")


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """JDBC scan (A1/A2).  A SQL text uses the ``query`` option; a large
    table should be read with ``dbtable`` + a numeric partition column and
    bounds so the scan is split across tasks (filters placed on the result
    are pushed into the database)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink (A9), optionally partitioned (e.g. by feature)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited-text sink with header."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def dated_path(base: str, name: str, day: _dt.date | None = None) -> str:
    """Output name stamped with the run date."""
    day = day or _dt.date.today()
    return os.path.join(base, f"{name}_{day.isoformat()}")


def cut_lineage(df: DataFrame, how: str = "checkpoint", name: str | None = None) -> DataFrame:
    """Materialise an intermediate result (A14) so later stages and retries
    start from it: a reliable ``checkpoint()`` or a Parquet table, both in
    the shared folder named by ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "table":
        path = os.path.join(folder, "tables", name or f"t{abs(hash(df.semanticHash()))}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    raise ValueError(how)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder named by
    ``spark.checkpoint.dir``, read back with the same schema: what is
    partition-dependent in it is fixed from then on, and later stages or
    retried tasks start from the files."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Partitioned Parquet sink that replaces the partitions it writes and
    leaves all others (dynamic partition overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_metric_table(df: DataFrame, path: str, decimals: int = 3, order_by: list[str] | None = None, sep: str = ",") -> None:
    """Result-table sink (A11): every floating column rounded, rows in order,
    one delimited file with a header.  For tables of metrics and counts: the
    order makes one task write them."""
    kinds = {"double", "float"}
    out = df.select(*[F.round(c, decimals).alias(c) if t in kinds or t.startswith("decimal") else F.col(c) for c, t in df.dtypes])
    out = out.orderBy(*(order_by or out.columns[:1])).coalesce(1)
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_sources_tolerant(spark: SparkSession, sources: dict[str, str], schema: T.StructType | str, feature_col: str = "feature",
                          reader: Callable[[str], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per-feature sources read one by one, each in isolation (A15): the union
    of those that can be read, in the columns and types of ``schema`` (missing
    columns are null) with the feature's name, and a log ``(feature, path,
    ok, error)`` of all.  A source fails if it is missing, is no Parquet file,
    or has a column of ``schema`` in a type that does not cast safely; its
    footers are read now, its rows with the union."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    read = reader or spark.read.parquet
    parts, log = [], []
    for name, path in sorted(sources.items()):
        try:
            df = read(path)
            have = {f.name: f.dataType for f in df.schema.fields}
            odd = [f.name for f in schema.fields if f.name in have and not _widens(have[f.name], f.dataType)]
            if odd:
                raise ValueError(f"columns of another type: {', '.join(odd)}")
            cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
            parts.append(df.select(F.lit(name).alias(feature_col), *cols))
            log.append((name, path, True, None))
        except Exception as e:                           # whatever this one source does, the others are read
            log.append((name, path, False, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]))
    full = T.StructType([T.StructField(feature_col, T.StringType()), *schema.fields])
    out = spark.createDataFrame([], full)
    for p in parts:
        out = out.unionByName(p)
    return out, spark.createDataFrame(log, "feature string, path string, ok boolean, error string")


def _widens(a: T.DataType, b: T.DataType) -> bool:
    """Whether every value of type ``a`` is one of type ``b``."""
    if a == b or isinstance(a, T.NullType):
        return True
    ranks = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(a) in ranks and type(b) in ranks:
        return ranks.index(type(a)) <= ranks.index(type(b))
    if isinstance(b, T.DoubleType):
        return isinstance(a, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType))
    return isinstance(b, T.StringType) and isinstance(a, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType))
