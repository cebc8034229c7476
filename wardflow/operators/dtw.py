"""Dynamic-time-warping clustering of entity series (k medoids).

Spark runs the work: the series are written once and stay distributed; per
iteration one Arrow-batched ``mapInPandas`` pass assigns every series to the
medoids of all requested k at once, and Spark aggregates pick the new medoids.
Only the medoids and the clusters' mean series (sum of k times the length)
reach the driver.  Per-row Python is limited to the DTW recursion, vectorised
over the batch, and most of it is skipped: an envelope of each medoid within
the warping window bounds the distance from below, and a series is warped
against a medoid only if that bound is under its second-best distance so far.

Medoid update: the member of each cluster closest (DTW) to the cluster's
point-wise mean series -- one distance per series, never all pairs inside a
cluster.  This replaces DTW barycentre averaging (an approximation,
documented as such).  The silhouette is the simplified one, against medoids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.models import key_hash
from wardflow.sources.io import write_scratch


def dtw_to(batch: np.ndarray, ref: np.ndarray, window: int | None = None) -> np.ndarray:
    """DTW distance (squared-difference cost, square root of the optimal
    path cost) from each row of ``batch`` (n x L) to ``ref`` (M,); paths stay
    within ``window`` of the diagonal, if given."""
    n, length = batch.shape
    m = len(ref)
    reach = m if window is None else max(window, abs(length - m))
    prev = np.full((n, m + 1), np.inf)
    prev[:, 0] = 0.0
    for i in range(length):
        cur = np.full((n, m + 1), np.inf)
        xi = batch[:, i]
        for j in range(max(1, i + 1 - reach), min(m, i + 1 + reach) + 1):
            cost = (xi - ref[j - 1]) ** 2
            cur[:, j] = cost + np.minimum(np.minimum(prev[:, j], cur[:, j - 1]), prev[:, j - 1])
        prev = cur
    return np.sqrt(prev[:, m])


def lower_bound(batch: np.ndarray, ref: np.ndarray, window: int | None = None) -> np.ndarray:
    """At most ``dtw_to``: how far each series of the reference's length lies
    outside the reference's envelope, or apart at both ends."""
    m = len(ref)
    reach = m if window is None else window
    high = np.array([ref[max(0, i - reach):i + reach + 1].max() for i in range(m)])
    low = np.array([ref[max(0, i - reach):i + reach + 1].min() for i in range(m)])
    outside = np.maximum(batch - high, 0.0) + np.maximum(low - batch, 0.0)
    ends = (batch[:, 0] - ref[0]) ** 2 + ((batch[:, -1] - ref[-1]) ** 2 if m > 1 else 0.0)
    return np.sqrt(np.maximum((outside ** 2).sum(axis=1), ends))


def two_nearest(x: np.ndarray, medoids: np.ndarray, window: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest medoid (the first of equal ones), its distance, that of the
    second, and how many warpings it took."""
    bounds = np.column_stack([lower_bound(x, m, window) for m in medoids])
    dist = np.full(bounds.shape, np.inf)
    best = np.full((len(x), 2), np.inf)
    full = 0
    for rank in range(len(medoids)):
        turn = np.argsort(bounds, axis=1, kind="stable")[:, rank]
        for c in range(len(medoids)):
            rows = np.flatnonzero((turn == c) & (bounds[:, c] <= best[:, 1]))
            if len(rows):
                full += len(rows)
                d = dtw_to(x[rows], medoids[c], window)
                dist[rows, c] = d
                best[rows] = np.sort(np.column_stack([best[rows], d]), axis=1)[:, :2]
    k = dist.argmin(axis=1)
    return k, best[:, 0], best[:, 1], full


def _assign_fn(entity: str, sets: dict[int, np.ndarray], window: int | None):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf["series"].to_numpy()).astype(float)
            for k, medoids in sets.items():
                cluster, near, second, full = two_nearest(x, medoids, window)
                yield pd.DataFrame({entity: pdf[entity].to_numpy(), "series": pdf["series"].to_numpy(), "k": np.int32(k), "cluster": cluster.astype("int32"),
                                    "dist": near, "second": second, "share": full / (len(x) * len(medoids))})
    return run


def _centre_fn(entity: str, centres: dict[tuple[int, int], np.ndarray], window: int | None):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            out = np.empty(len(pdf))
            x = np.vstack(pdf["series"].to_numpy()).astype(float)
            for key, rows in pdf.groupby(["k", "cluster"]).indices.items():
                out[rows] = dtw_to(x[rows], centres[int(key[0]), int(key[1])], window)
            yield pd.DataFrame({entity: pdf[entity].to_numpy(), "series": pdf["series"].to_numpy(), "k": pdf["k"].to_numpy(),
                                "cluster": pdf["cluster"].to_numpy(), "apart": out})
    return run


def dtw_sweep(series: DataFrame, entity: str, ks: list[int], window: int | None = None, max_iter: int = 10,
              seed: int = 42) -> tuple[DataFrame, dict[int, tuple[int, bool]]]:
    """DTW k medoids for every k of ``ks`` over ``(entity, series)`` rows of
    one length: ``(entity, k, cluster, dist, second, share)`` -- distances to
    the own and the next medoid, and the share of warpings that were needed --
    and ``{k: (iterations, converged)}``.  A k of more than the number of
    series is left out; so is an empty table."""
    s = write_scratch(series.select(entity, F.col("series").cast("array<double>").alias("series")), "series")
    kind = s.schema[entity].dataType.simpleString()
    first = s.withColumn("_h", key_hash(F.col(entity), seed, 1_000_003)).orderBy("_h", entity).limit(max(ks)).collect()   # the largest k rows
    start = [np.array(r["series"], dtype=float) for r in first]
    sets = {k: np.vstack(start[:k]) for k in ks if k <= len(start)}
    ended = {k: (0, False) for k in sets}
    schema = f"{entity} {kind}, series array<double>, k int, cluster int, dist double, second double, share double"
    done: list[DataFrame] = []
    for it in range(1, max_iter + 1):
        moving = {k: m for k, m in sets.items() if not ended[k][1]}
        if not moving:
            break
        members = write_scratch(s.mapInPandas(_assign_fn(entity, moving, window), schema), "members")
        means = (members.select("k", "cluster", F.posexplode("series").alias("pos", "v")).groupBy("k", "cluster", "pos").agg(F.avg("v").alias("v"))
                 .groupBy("k", "cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("mean")).collect())    # sum of k rows
        centres = {(r["k"], r["cluster"]): np.array([x["v"] for x in r["mean"]]) for r in means}
        near = members.select(entity, "series", "k", "cluster").mapInPandas(_centre_fn(entity, centres, window),
                                                                         f"{entity} {kind}, series array<double>, k int, cluster int, apart double")
        picked = near.groupBy("k", "cluster").agg(F.min_by("series", F.struct("apart", entity)).alias("medoid")).collect()       # sum of k rows
        for k in moving:
            new = sets[k].copy()
            for r in picked:
                if r["k"] == k:
                    new[r["cluster"]] = r["medoid"]
            ended[k] = (it, np.array_equal(new, sets[k]))
            sets[k] = new
        still = [k for k in moving if ended[k][1]]
        if still:
            done.append(members.filter(F.col("k").isin(still)))
    left = {k: m for k, m in sets.items() if not ended[k][1]}
    if left or not done:
        done.append(s.mapInPandas(_assign_fn(entity, left, window), schema))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("series"), ended


def dtw_kmedoids(series: DataFrame, entity: str, k: int, window: int | None = None, max_iter: int = 10, seed: int = 42) -> DataFrame:
    """:func:`dtw_sweep` for one k: ``(entity, cluster, dist, converged)``."""
    out, ended = dtw_sweep(series, entity, [k], window, max_iter, seed)
    return out.select(entity, "cluster", "dist", F.lit(ended.get(k, (0, False))[1]).alias("converged"))
