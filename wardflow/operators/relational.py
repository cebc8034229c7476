"""Relational building blocks: keep-first per key, semi/anti filters, unify
schemas, value counts and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order_key(df: DataFrame, c: str, desc: bool) -> Column:
    """Order key for ``min_by``: descending columns are negated, texts in
    byte order; nulls stay null, i.e. sort first in both directions."""
    if not desc:
        return F.col(c)
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(F.col(c).cast("timestamp"))
    if isinstance(dt, T.DateType):
        return -F.unix_date(F.col(c))
    if isinstance(dt, (T.NumericType,)):
        return -F.col(c)
    if isinstance(dt, T.StringType):                     # digits of the bytes complemented; the mark puts longer texts before their beginnings
        return F.concat(F.translate(F.hex(F.col(c)), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
    if isinstance(dt, T.BooleanType):
        return ~F.col(c)
    raise TypeError(f"descending order on {dt} needs a window (column {c})")


def first_per_key(df: DataFrame, keys: list[str], order: list[tuple[str, bool]],
                  cols: list[str] | None = None) -> DataFrame:
    """Keep the first row per key in ``order`` (list of ``(column, desc)``).

    Written as a ``min_by`` aggregation rather than ``row_number() = 1``:
    partial aggregation keeps one candidate per key per map task, so a key
    holding a third of all rows never lands whole in one task.  ``order``
    must be a total order (add the row's id as the last key)."""
    cols = cols or [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in cols])
    ok = F.struct(*[_order_key(df, c, d).alias(f"_o{i}") for i, (c, d) in enumerate(order)])
    agg = df.groupBy(*keys).agg(F.min_by(row, ok).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in cols])


def value_counts(df: DataFrame, c: str, min_count: int = 0) -> DataFrame:
    out = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return out.filter(F.col("n") > min_count) if min_count else out


def histogram(df: DataFrame, c: str, width: float, lo: float = 0.0, name: str = "bin") -> DataFrame:
    """Fixed-width bins ``floor((x - lo) / width)``; null values skipped."""
    b = F.floor((F.col(c) - F.lit(lo)) / F.lit(width))
    return (df.filter(F.col(c).isNotNull()).groupBy(b.alias(name))
            .agg(F.count(F.lit(1)).alias("n")))


def unify(frames: list[tuple[DataFrame, dict[str, str]]], columns: dict[str, str],
          source_col: str = "source") -> DataFrame:
    """Rename each source to the canonical names, add missing canonical
    columns as typed nulls, cast, tag the source and union by name."""
    out = None
    for i, (df, renames) in enumerate(frames):
        d = df.withColumnsRenamed(renames)
        sel = [(F.col(c) if c in d.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
        d = d.select(*sel, F.lit(i).alias(source_col))
        out = d if out is None else out.unionByName(d)
    return out
