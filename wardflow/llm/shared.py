"""Small helpers of the training-data operators: session preparation,
tables in the shared folder, size-checked broadcasts, hash draws."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import configure, ensure_checkpoint_dir

#: rows and bytes of an Arrow batch: whole texts of any length pass in batches of a few MB
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

#: the white space of every operator's tokens: space and the control characters 9 to 13
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and the package on the executors' Python path."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    return configure(spark)


def materialise(df: DataFrame, name: str, mode_options: dict | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table into the cluster's shared folder
    (``spark.checkpoint.dir``) and read it back: later stages, and tasks
    rerun after a lost executor, start from the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/wardflow-llm/{uuid.uuid4().hex}/{name}"
    df.write.options(**(mode_options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: a broadcast side holds at most so many bytes of values
MAX_BROADCAST_BYTES = 64 << 20


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(c)
    elif isinstance(kind, T.ArrayType):
        fixed = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
        size = F.size(c) * 8 if fixed else F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + _bytes(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        size = sum((_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(0))
    else:
        size = F.lit(0)
    return F.coalesce(size.cast("long"), F.lit(0)) + 8


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows and
    about ``max_bytes`` of values (both counted); otherwise unchanged, and
    Spark shuffles the join.  ``df`` should be materialised or cheap."""
    size = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    n, b = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return F.broadcast(df) if n <= max_rows and (b or 0) <= max_bytes else df


def free_name(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform(seed: int | Column, *cols: Column) -> Column:
    """Uniform draw in [0, 1) from the first 52 bits of an MD5 digest of the
    key: independent of partitioning, any key type, same value in SQL."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    text = F.concat_ws("|", seed.cast("string"), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def crc_mod(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
