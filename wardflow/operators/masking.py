"""Deterministic missing-data masks, simple imputers and error metrics.

Masks are driven by a digest of (entity, bin, feature index, seed), so a
mask is reproducible, independent of partitioning, and identical in a SQL
oracle.  All operators work on a long panel ``(keys..., bin, value)``
with one row per bin (a dense grid).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.operators import sequence as S
from wardflow.operators.ranks import number_rows
from wardflow.sources.io import write_scratch

UNB = Window.unboundedPreceding

#: draws have 52 bits
DRAW_BITS = 52


def digest(*key: Column | int) -> Column:
    """52-bit integer from the MD5 digest of the key's parts: any key type
    and size, independent between neighbouring keys, reproducible in SQL."""
    parts = [(F.lit(k) if isinstance(k, int) else k).cast("string") for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("long")


def digest_sql(*key: str) -> str:
    """:func:`digest` in DuckDB SQL."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, {DRAW_BITS // 4}) AS BIGINT)"


def uniform_hash(entity: Column, t: Column, feature_idx: Column, seed: Column | int) -> Column:
    """Uniform draw in [0, 1) per (entity, bin, feature, seed)."""
    return digest(entity, t, feature_idx, seed) / F.lit(float(1 << DRAW_BITS))


def feature_index(feature: str, features: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in features]), F.col(feature))


def random_mask(value: str, u: Column, rate: float | Column) -> Column:
    """MCAR cell mask: observed cells with ``u < rate`` become null."""
    rate = F.lit(rate) if isinstance(rate, float) else rate
    return F.when(u < rate, F.lit(None)).otherwise(F.col(value))


def impute_all(df: DataFrame, keys: list[str], t: str, masked: str,
               global_keys: list[str] | None = None) -> DataFrame:
    """Adds ``imp_mean``, ``imp_median``, ``imp_locf`` (forward then
    backward fill) and ``imp_linear`` (linear interpolation, edges held) for
    the ``masked`` column.  Mean/median are per series (``keys``) by
    default; with ``global_keys`` (e.g. scenario and feature, without the
    entity) they are pooled over all entities -- an aggregate with one row
    per global key, joined back."""
    if global_keys is None:
        w_all = Window.partitionBy(*keys)
        stats = {"imp_mean": F.coalesce(F.col(masked), F.avg(masked).over(w_all)),
                 "imp_median": F.coalesce(F.col(masked), F.median(masked).over(w_all))}
    else:
        g = df.groupBy(*global_keys).agg(F.avg(masked).alias("_gmean"), F.median(masked).alias("_gmed"))
        df = df.join(g, global_keys, "left")
        stats = {"imp_mean": F.coalesce(F.col(masked), F.col("_gmean")),
                 "imp_median": F.coalesce(F.col(masked), F.col("_gmed"))}
    df = df.withColumns({**stats, "imp_locf": F.col(masked), "imp_linear": F.col(masked)})
    if global_keys is not None:
        df = df.drop("_gmean", "_gmed")
    df = S.ffill_bfill(df, keys, t, ["imp_locf"])
    return S.interpolate(df, keys, t, ["imp_linear"], "both")


METHODS = ["imp_mean", "imp_median", "imp_locf", "imp_linear"]


def errors(df: DataFrame, group: list[str], original: str, masked: str, imputed: str) -> DataFrame:
    """MAE / RMSE over the indicating mask: cells observed in ``original``
    and missing in ``masked`` (mask XOR originally missing)."""
    ind = F.col(original).isNotNull() & F.col(masked).isNull()
    d = F.when(ind, F.col(imputed) - F.col(original))
    return df.groupBy(*group).agg(
        F.count(d).alias("n"), F.round(F.avg(F.abs(d)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse"))


def impute_wide(df: DataFrame, keys: list[str], t: str, cols: list[str], name: str = "{method}_{col}") -> DataFrame:
    """The four simple imputations of the masked columns ``cols`` of a wide
    panel, each as a column ``name``: per series (``keys``) one ascending and
    one descending window find the observed neighbours, from which both the
    fills and the interpolation follow."""
    whole = Window.partitionBy(*keys)
    d = S.neighbours(df.withColumns({k: v for c in cols for k, v in ((f"_avg_{c}", F.avg(c).over(whole)), (f"_med_{c}", F.median(c).over(whole)))}),
                     keys, t, cols)
    out = {}
    for c in cols:
        x, p, n = F.col(c), F.col(f"_p_{c}")["v"], F.col(f"_n_{c}")["v"]
        for method, value in (("imp_mean", F.coalesce(x, f"_avg_{c}")), ("imp_median", F.coalesce(x, f"_med_{c}")), ("imp_locf", F.coalesce(p, n)),
                              ("imp_linear", F.when(x.isNotNull(), x).otherwise(F.coalesce(S.between(c), p, n)))):
            out[name.format(method=method, col=c)] = value
    return d.withColumns(out).drop("_i", *[f"_{k}_{c}" for c in cols for k in ("avg", "med", "p", "n")])


def target_share_hits(df: DataFrame, entity: str, t: str, feats: list[str], scenarios: list[dict], horizon: int) -> DataFrame:
    """Block masks added in hash order until the newly masked observed cells
    reach ``floor(rows * features * rate)`` -- the sequential rule for many
    scenarios at once, computed without a sequential loop.

    ``df`` is a dense wide panel (one row per entity and bin); a scenario has
    ``scenario`` (name), ``n`` (block length), ``only`` (one feature, or None
    for all together), ``rate`` and ``seed``.  Every bin ``T0 < horizon - 1``
    is a candidate block start with key ``(digest(seed, entity, T0), entity,
    T0)``; a block covers ``[T0, min(T0 + n, horizon - 1))``.  A cell is masked
    by the earliest block covering it -- a width-n window minimum over the
    entity's bins -- so the blocks of a key prefix mask exactly the cells whose
    first covering key lies in it.

    The panel with its covers is written once; all scenarios share one window
    over the entity.  The threshold key is found in two small aggregates: the
    observed cells per range of the (uniform) digest tell the range in which
    the running count reaches the target, the keys of that range the key.
    There are about as many ranges as keys in a range, the square root of the
    rows.

    Returns ``entity, t, feats`` and one boolean ``_hit_{k}`` per scenario."""
    inside = F.col(t) < F.lit(horizon - 1)
    w = Window.partitionBy(entity).orderBy(t)
    k = range(len(scenarios))
    x = df.select(entity, t, *feats).withColumns({
        f"_start_{i}": F.when(inside, F.struct(digest(s["seed"], F.col(entity), F.col(t)).alias("h"), F.col(entity).alias("e"), F.col(t).alias("t")))
        for i, s in enumerate(scenarios)})
    x = x.withColumns({f"_cover_{i}": F.when(inside, F.min(f"_start_{i}").over(w.rowsBetween(1 - s["n"], 0))) for i, s in enumerate(scenarios)})
    x = write_scratch(x.drop(*[f"_start_{i}" for i in k]), "covers")
    rows = x.count()
    shift = DRAW_BITS - max(4, rows.bit_length() // 2)
    goals = [math.floor(rows * (len(feats) if s["only"] is None else 1) * float(s["rate"])) for s in scenarios]

    def seen(s: dict) -> Column:
        return sum([F.col(c).isNotNull().cast("long") for c in feats if s["only"] in (None, c)], F.lit(0).cast("long"))

    each = x.select(F.inline(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"_cover_{i}").alias("cover"), seen(s).alias("n"),
                                                F.lit(g).alias("goal")) for (i, s), g in zip(enumerate(scenarios), goals)]))).filter("cover IS NOT NULL")
    each = each.withColumn("range", F.shiftright("cover.h", shift))
    along = Window.partitionBy("k").orderBy("range").rowsBetween(UNB, 0)
    per_range = each.groupBy("k", "goal", "range").agg(F.sum("n").alias("n")).withColumn("cum", F.sum("n").over(along))
    first = F.min_by(F.struct("range", (F.col("cum") - F.col("n")).alias("before")), F.when(F.col("cum") >= F.col("goal"), F.col("range")))
    found = {r["k"]: r["at"] for r in per_range.groupBy("k").agg(first.alias("at")).collect()}     # one row per scenario
    at = [found[i] if found.get(i) is not None else None for i in k]
    hits = {f"_hit_{i}": F.col(f"_cover_{i}").isNotNull() for i in k}              # target out of reach: every block
    inner = [i for i in k if at[i] is not None]
    if inner:
        one = F.lit(False)
        before = F.lit(0)
        for i in inner:
            one = one | ((F.col("k") == i) & (F.col("range") == at[i]["range"]))
            before = F.when(F.col("k") == i, F.lit(at[i]["before"])).otherwise(before)
        keys = each.filter(one).groupBy("k", "goal", "cover").agg(F.sum("n").alias("n"))
        run = Window.partitionBy("k").orderBy("cover").rowsBetween(UNB, 0)
        keys = keys.withColumn("cum", before + F.sum("n").over(run)).filter("cum >= goal").groupBy("k").agg(F.min("cover").alias("last"))
        last = keys.agg(F.map_from_entries(F.collect_list(F.struct("k", "last"))).alias("last")).select("last").scalar()    # one entry per scenario
        hits |= {f"_hit_{i}": F.coalesce(F.col(f"_cover_{i}") <= last[i], F.lit(False)) for i in inner}
    return x.withColumns(hits).select(entity, t, *feats, *hits)


def target_share_masks(df: DataFrame, entity: str, t: str, feats: list[str], scenarios: list[dict],
                       horizon: int) -> DataFrame:
    """:func:`target_share_hits` as rows: those of every scenario with
    ``scenario, only`` and ``_hit``."""
    x = target_share_hits(df, entity, t, feats, scenarios, horizon)
    each = F.array(*[F.struct(F.lit(s["scenario"]).alias("scenario"), F.lit(s["only"]).cast("string").alias("only"), F.col(f"_hit_{i}").alias("_hit"))
                     for i, s in enumerate(scenarios)])
    return x.select(F.inline(each), entity, t, *feats).select("scenario", "only", entity, t, *feats, "_hit")


def masked_long(masks: DataFrame, entity: str, t: str, feats: list[str]) -> DataFrame:
    """``(scenario, only, entity, t, feature, original, masked)`` of
    :func:`target_share_masks`."""
    x = masks.unpivot(["scenario", "only", entity, t, "_hit"], feats, "feature", "original")
    own = F.col("only").isNull() | (F.col("only") == F.col("feature"))
    return x.withColumn("masked", F.when(F.col("_hit") & own, F.lit(None)).otherwise(F.col("original"))).drop("_hit")


def target_share_block_mask(df: DataFrame, entity: str, t: str, feats: list[str], n: int, horizon: int,
                            rate: float, seed: int, name_prefix: str = "m_") -> DataFrame:
    """One scenario of :func:`target_share_masks` on all ``feats``, as
    ``df`` with masked copies of its columns."""
    x = target_share_masks(df.select(entity, t, *feats), entity, t, feats,
                           [{"scenario": "s", "n": n, "only": None, "rate": rate, "seed": seed}], horizon)
    return x.select(entity, t, *feats, *[F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(c)).alias(f"{name_prefix}{c}")
                                         for c in feats])


#: passes of the repeated random mask at most; each halves the rate of the one before
PASSES = 12


def random_until_target(df: DataFrame, entity: str, t: str, feats: list[str], rate: float, seed: int) -> DataFrame:
    """Cells masked at random, pass after pass at half the rate, until at most
    ``1 - rate`` of the observed cells are left.

    The pass that first hits a cell follows from the cell's own draws, so one
    aggregate (observed cells per first pass) tells how many passes it takes;
    no pass is run.  Adds ``m_<feature>``."""
    def first(c: str, j: int) -> Column:
        out = F.lit(None).cast("int")
        for k in reversed(range(PASSES)):
            u = digest(F.col(entity), F.col(t), j, seed, k) / F.lit(float(1 << DRAW_BITS))
            out = F.when(u < F.lit(rate / 2 ** k), k).otherwise(out)
        return F.when(F.col(c).isNotNull(), out)

    x = write_scratch(df.withColumns({f"_first_{c}": first(c, j + 1) for j, c in enumerate(feats)}), "passes")
    long = x.select(F.explode(F.array(*[F.struct(F.col(c).isNotNull().alias("seen"), F.col(f"_first_{c}").alias("k")) for c in feats])).alias("c"))
    per = {r["k"]: r["n"] for r in long.filter("c.seen").groupBy("c.k").agg(F.count(F.lit(1)).alias("n")).collect()}    # PASSES + 1 rows
    left = sum(per.values())
    goal, passes = left * (1 - rate), 0
    while passes < PASSES and left > goal:
        left -= per.get(passes, 0)
        passes += 1
    hit = {f"m_{c}": F.when(F.col(f"_first_{c}") < passes, F.lit(None)).otherwise(F.col(c)) for c in feats}
    return x.withColumns(hit).drop(*[f"_first_{c}" for c in feats])


def counted_blocks(df: DataFrame, entity: str, t: str, feats: list[str], n: int, horizon: int, rate: float, seed: int,
                   only: list[str] | None = None) -> DataFrame:
    """``floor(rows * rate / n)`` blocks drawn with replacement: an entity by
    its number, a start bin, and the ``n`` bins from it (the last bin never)
    masked in ``only`` (default: all features).  ``df`` is a dense wide panel
    of ``horizon`` bins.  Adds ``m_<feature>``."""
    entities = number_rows(df.select(entity).distinct(), [F.col(entity).asc()], None, "_no", "_of")
    sizes = entities.agg(F.max("_of").alias("e")).first()
    many = sizes["e"] or 0
    blocks = int(many * horizon * rate / n)
    u = [digest(seed, F.col("id"), k) / F.lit(float(1 << DRAW_BITS)) for k in (0, 1)]
    draws = df.sparkSession.range(blocks).select(F.floor(u[0] * many).alias("_no"), F.floor(u[1] * horizon).alias("_t0"))
    last = F.least(F.col("_t0") + n, F.lit(horizon - 1)) - 1
    cells = draws.filter(F.col("_t0") < horizon - 1).select("_no", F.explode(F.sequence(F.col("_t0"), last)).alias(t)).distinct()
    hit = cells.join(entities, "_no").select(entity, t, F.lit(True).alias("_hit"))
    x = df.join(hit, [entity, t], "left")
    own = feats if only is None else only
    return x.withColumns({f"m_{c}": F.when(F.col("_hit") & F.lit(c in own), F.lit(None)).otherwise(F.col(c)) for c in feats}).drop("_hit")


def random_cells(df: DataFrame, entity: str, t: str, feats: list[str], rate: float, seed: int) -> DataFrame:
    """Each observed cell masked with probability ``rate``, once."""
    return df.withColumns({f"m_{c}": random_mask(c, uniform_hash(F.col(entity), F.col(t), F.lit(j + 1), seed), rate) for j, c in enumerate(feats)})


def masked_panel(df: DataFrame, entity: str, t: str, feats: list[str], mask: Callable[..., DataFrame] | None = None, **options) -> DataFrame:
    """A panel with masked copies ``m_<feature>`` of its features: ``mask`` is
    any function ``(df, entity, t, feats, **options)`` that adds them --
    ``random_cells``, ``random_until_target``, ``counted_blocks``,
    ``target_share_block_mask`` or the caller's own; None masks nothing.  What
    a mask may do is checked in the plan: it only removes."""
    x = df.withColumns({f"m_{c}": F.col(c) for c in feats}) if mask is None else mask(df, entity, t, feats, **options)
    missing = [f"m_{c}" for c in feats if f"m_{c}" not in x.columns]
    if missing:
        raise ValueError(f"the mask did not add {missing}")
    return x.withColumns({f"m_{c}": F.when(F.col(f"m_{c}").isNotNull(), F.col(c)) for c in feats})
