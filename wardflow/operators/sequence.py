"""Per-entity sequence operators as window expressions.

Every window is partitioned by the entity and ordered by the bin.  Operators
expect a *binned* panel (one row per entity and bin), so a partition holds at
most span/bin rows of one entity.  Frames are always running frames
(``unboundedPreceding .. current`` or a fixed width); look-ahead is written as
a running frame in descending order, which Spark evaluates in O(n) instead of
re-evaluating an unbounded-following frame per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.scalar import r6

UNB = Window.unboundedPreceding


def _keys(entity: str | list[str]) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def _asc(entity: str, t: str, lo=UNB, hi=0) -> Window:
    return Window.partitionBy(*_keys(entity)).orderBy(F.col(t).asc()).rowsBetween(lo, hi)


def _desc(entity: str, t: str, lo=UNB, hi=0) -> Window:
    return Window.partitionBy(*_keys(entity)).orderBy(F.col(t).desc()).rowsBetween(lo, hi)


def ffill(df: DataFrame, entity: str, t: str, cols: list[str]) -> DataFrame:
    w = _asc(entity, t)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def bfill(df: DataFrame, entity: str, t: str, cols: list[str]) -> DataFrame:
    w = _desc(entity, t)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def ffill_bfill(df: DataFrame, entity: str, t: str, cols: list[str]) -> DataFrame:
    """Forward fill, then backward fill what is still missing (leading gap)."""
    return bfill(ffill(df, entity, t, cols), entity, t, cols)


def neighbours(df: DataFrame, entity: str | list[str], t: str, cols: list[str], exclude_self: bool = False) -> DataFrame:
    """Adds ``_i`` (row position) and, per column, ``_p_c``/``_n_c`` structs
    ``(i, v)`` of the previous/next observed row."""
    hi = -1 if exclude_self else 0
    df = df.withColumn("_i", F.row_number().over(Window.partitionBy(*_keys(entity)).orderBy(t)))
    prev = {f"_p_{c}": F.last(F.when(F.col(c).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(c).alias("v"))),
                              ignorenulls=True).over(_asc(entity, t, UNB, hi)) for c in cols}
    df = df.withColumns(prev)
    nxt = {f"_n_{c}": F.last(F.when(F.col(c).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(c).alias("v"))),
                             ignorenulls=True).over(_desc(entity, t, UNB, hi)) for c in cols}
    return df.withColumns(nxt)


def between(c: str) -> Column:
    """Value of column ``c`` on the line between its :func:`neighbours`."""
    p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
    frac = (F.col("_i") - p["i"]) / (n["i"] - p["i"])
    return p["v"] + (n["v"] - p["v"]) * frac


def interpolate(df: DataFrame, entity: str, t: str, cols: list[str], edges: str = "both") -> DataFrame:
    """Linear interpolation by row position.

    ``edges``: ``both`` (leading gap takes the next value, trailing gap the
    previous one), ``inside`` (edges stay null), ``forward`` (leading gap
    null, trailing gap holds the previous value).  Observed cells unchanged.
    """
    nb = neighbours(df, entity, t, cols, exclude_self=False)
    out = {}
    for c in cols:
        p, n = F.col(f"_p_{c}")["v"], F.col(f"_n_{c}")["v"]
        inner = between(c)
        if edges == "both":
            filled = F.coalesce(inner, p, n)
        elif edges == "inside":
            filled = inner
        elif edges == "forward":
            filled = F.coalesce(inner, p)
        else:
            raise ValueError(edges)
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(filled)
    drop = ["_i"] + [f"_p_{c}" for c in cols] + [f"_n_{c}" for c in cols]
    return nb.withColumns(out).drop(*drop)


def loo_estimate(df: DataFrame, entity: str, t: str, c: str, name: str = "estimate") -> DataFrame:
    """Leave-one-out linear interpolation of observed cells: each observed
    row is re-estimated from its observed neighbours (itself excluded);
    edges take the nearest neighbour.  One window pass, no per-cell loop."""
    nb = neighbours(df, entity, t, [c], exclude_self=True)
    p, n = F.col(f"_p_{c}")["v"], F.col(f"_n_{c}")["v"]
    est = F.when(F.col(c).isNotNull(), F.coalesce(between(c), p, n))
    return nb.withColumn(name, est).drop("_i", f"_p_{c}", f"_n_{c}")


def run_ids(df: DataFrame, entity: str, t: str, flag: Column, name: str = "run") -> DataFrame:
    """Gaps-and-islands: ``run`` = row number in the entity minus row number
    among rows with the same flag; (entity, flag, run) identifies a run."""
    df = df.withColumn("_flag", flag)
    rn_all = F.row_number().over(Window.partitionBy(*_keys(entity)).orderBy(t))
    rn_flag = F.row_number().over(Window.partitionBy(*_keys(entity), "_flag").orderBy(t))
    return df.withColumn(name, rn_all - rn_flag)


def run_lengths(df: DataFrame, entity: str, t: str, flag: Column) -> DataFrame:
    """``(entity, flag, run, start, length)`` for every run."""
    r = run_ids(df, entity, t, flag)
    return (r.groupBy(*_keys(entity), "_flag", "run")
            .agg(F.min(t).alias("start"), F.count(F.lit(1)).alias("length"))
            .withColumnRenamed("_flag", "flag"))


def position_in_run(df: DataFrame, entity: str, t: str, c: str, name: str) -> DataFrame:
    """1, 2, 3 ... along each run of missing ``c``; 0 on observed rows."""
    r = run_ids(df, entity, t, F.col(c).isNull(), "_run")
    w = Window.partitionBy(*_keys(entity), "_flag", "_run").orderBy(t).rowsBetween(UNB, 0)
    return (r.withColumn(name, F.sum(F.col(c).isNull().cast("int")).over(w))
            .drop("_flag", "_run"))


def _field_is_null(c: str):
    return lambda x: x[c].isNull()


def sliding_windows(df: DataFrame, entity: str, t: str, cols: list[str], width: int) -> DataFrame:
    """Windows of ``width`` consecutive rows starting at every row; keeps the
    complete ones (``width`` rows, no null in any column).  ``win`` holds the
    rows as an array of structs (``collect_list`` of a struct keeps nulls
    inside the struct, so completeness is tested explicitly)."""
    w = _asc(entity, t, 0, width - 1)
    st = F.struct(F.col(t).alias("t"), *[F.col(c).alias(c) for c in cols])
    out = df.select(*_keys(entity), F.col(t).alias("start"), F.collect_list(st).over(w).alias("win"))
    complete = F.size("win") == width
    for c in cols:
        complete = complete & ~F.exists("win", _field_is_null(c))
    return out.filter(complete)


def volume_rate(df: DataFrame, entity, t: str, c: str, name: str) -> DataFrame:
    """Cumulative volume -> rate.  Readings are rows with a non-null, non-zero
    volume at t1 < t2 < ...; a row in (t_{k-1}, t_k] gets v_k / (t_k - t_{k-1});
    rows at or before t1 get v_1 / (t1 - t_first) (v_1 when t1 = t_first);
    rows after the last reading hold the last rate."""
    reading = F.col(c).isNotNull() & (F.col(c) != 0)
    rd = F.when(reading, F.struct(F.col(t).alias("t"), F.col(c).alias("v")))
    # next reading at or after the row (descending running frame)
    nxt = F.last(rd, ignorenulls=True).over(_desc(entity, t))
    # last reading strictly before the row = reading preceding the next one
    prv = F.last(F.when(reading, F.col(t)), ignorenulls=True).over(_asc(entity, t, UNB, -1))
    tfirst = F.min(t).over(Window.partitionBy(*_keys(entity)))
    df = df.withColumns({"_nx": nxt, "_pt": prv, "_t0": tfirst})
    nt, nv = F.col("_nx")["t"], F.col("_nx")["v"]
    rate_here = (F.when(F.col("_nx").isNull(), F.lit(None))
                 .when(F.col("_pt").isNotNull(), nv / (nt - F.col("_pt")))
                 .when(nt == F.col("_t0"), nv)
                 .otherwise(nv / (nt - F.col("_t0"))))
    df = df.withColumn("_r", rate_here.cast("double"))
    held = F.last("_r", ignorenulls=True).over(_asc(entity, t))
    return df.withColumn(name, F.coalesce(F.col("_r"), held)).drop("_nx", "_pt", "_t0", "_r")
