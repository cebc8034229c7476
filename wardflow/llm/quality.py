"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams (words, and one to three consecutive word
shapes: which kinds of characters a word has, its length class, whether it
repeats the word before) are scaled by their class log-count ratios; a linear
hinge-loss model is fitted on them by dual coordinate descent, and its margin
is mapped to a probability on rows set aside for that (a fifth, by a hash of
the id).

The model learns from every labelled document (of rows repeated with an id,
from the text of smallest hash): ratios, class costs and probability are sums
over all of them, and all have a dual variable in one model.  They are dealt by
a hash of the id to shards of about ``SHARD_FEATURES`` features.  In each of
``ROUNDS`` rounds every shard descends on its own dual variables from the
common weights, and the mean of the shards' steps is added to variables and
weights, which never lowers the dual objective of the whole.  One shard makes
all its passes in one round.  Memory per task: one shard's features.  Whole
texts are used, in training and scoring.  Only the text is an input of the
score.

Defined cases: null text is empty and is scored by the bias alone; labels
that are null, conflicting (the larger counts) or of unknown documents are
tolerated; with labels of one class only the score is that class's share;
without any training row it is 0.5; rows stay one to one, also repeated ones; extra
columns are carried along by ``score_documents`` (one named ``score`` is
replaced); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.shared import bounded_broadcast, crc_mod, free_name, materialise
from wardflow.llm.tokens import LANES, Words, mix, slices, text_buffers

BITS = 18
SHARD_FEATURES, ROUNDS = 8_000_000, 6
MAX_BROADCAST_IDS = 4_000_000
#: folds below this, a fifth of all, are set aside
ASIDE = -(1 << 63) + (1 << 64) // 5
#: weights that are summed together
CHUNK = 1 << 12
THRESHOLD = 0.7
EPOCHS, COST, ALPHA = 12, 0.05, 1.0

_KIND = np.zeros(256, np.uint8)
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
_KIND[128:] = 8
_KIND[[33, 34, 35, 36, 37, 38, 39, 42, 43, 45, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126]] = 128
_KIND[[33]] = 32
_KIND[[124]] = 64
_KIND[[40, 41, 44, 46, 58, 59, 63]] = 16


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each document of a slice, with offsets."""
    n = len(offsets) - 1
    w = Words(data, offsets, lower=False)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    lower = Words(data, offsets, lower=True).hashes()
    own, exact = w.owner(), w.hashes()
    kind = np.bitwise_or.reduceat(_KIND[w.bytes], w.start).astype(np.uint64)
    same = np.zeros(len(exact), bool)
    same[1:] = (exact[1:] == exact[:-1]) & (own[1:] == own[:-1])
    shape = kind | (same.astype(np.uint64) << np.uint64(8)) | (np.minimum((w.end - w.start) // 6, 3).astype(np.uint64) << np.uint64(9))
    parts, owners = [mix(lower + np.uint64(LANES[0])), mix(shape + np.uint64(LANES[1]))], [own, own]
    gram = shape
    for k in (1, 2):
        gram = gram[:-1] * np.uint64(4099) + shape[k:]
        ok = own[k:] == own[:-k]
        parts.append(mix(gram[ok] + np.uint64(LANES[1 + k])))
        owners.append(own[k:][ok])
    key = (np.concatenate(owners).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(parts) >> np.uint64(64 - BITS))
    key = np.unique(key)
    return (key & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(BITS))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, off = text_buffers(b.column("text"))
        for i, j in slices(off):
            f, fo = features(data[off[i]:off[j]], off[i:j + 1] - off[i])
            yield pa.RecordBatch.from_arrays(
                [b.column("y").slice(i, j - i), b.column("fold").slice(i, j - i),
                 pa.ListArray.from_arrays(pa.array(fo, pa.int32()), pa.array(f, pa.int32()))], ["y", "fold", "f"])


def ratios(count: np.ndarray) -> np.ndarray:
    """Log ratios of each feature's share in the two classes' ``count``."""
    count = count + ALPHA
    count /= count.sum(axis=1, keepdims=True)
    return np.log(count[1] / count[0])


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    count = np.zeros((2, 1 << BITS))
    for f, c in zip(rows, y):
        count[int(c > 0), f] += 1
    return ratios(count)


def descend(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, bound: np.ndarray, w: np.ndarray, b: float, a: np.ndarray,
            epochs: int, seed: int) -> float:
    """Passes over the rows in random order; weights ``w`` and dual variables
    ``a`` (up to ``bound``) change in place, the bias is returned."""
    rng = np.random.default_rng(seed)
    x = [r[f] for f in rows]
    square = np.array([v @ v for v in x]) + 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ x[i] + b) - 1.0
            new = min(max(a[i] - g / square[i], 0.0), bound[i])
            if new != a[i]:
                step = (new - a[i]) * y[i]
                w[rows[i]] += step * x[i]
                b += step
                a[i] = new
    return b


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model on indicators scaled by ``r`` (and a bias
    feature); both classes carry the same total cost."""
    bound = cost * len(y) / (2.0 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    w = np.zeros(len(r))
    return w, descend(rows, y, r, bound, w, 0.0, np.zeros(len(y)), epochs, seed)


def _add(steps: pa.Table) -> pa.Table:
    """The sum of the shards' steps in one chunk of the weights."""
    steps = steps.sort_by("shard")
    total = sum(np.asarray(v.values.to_numpy()) for v in steps.column("v"))
    return pa.table({"at": steps.column("at").slice(0, 1), "v": pa.array([total], pa.list_(pa.float64()))})


def fit_weights(fit: DataFrame, r: np.ndarray, bound: dict[float, float], shards: int) -> tuple[np.ndarray, float]:
    """Weights on the scaled indicators and bias of one model over all rows of
    ``fit`` (``y, fold, f``); ``bound`` is the largest dual variable of each
    class.  Per round 2**BITS numbers reach the driver; the dual variables stay
    in the shared folder."""
    spark = fit.sparkSession
    rounds = ROUNDS if shards > 1 else 1
    shard = F.pmod(F.xxhash64(F.lit(7), "fold"), F.lit(shards)).cast("int").alias("shard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = fit.select("y", "fold", "f", shard).repartition(parts, "shard").sortWithinPartitions("shard", "fold").persist()   # dealt once for all rounds
    duals = spark.createDataFrame([], "shard int, v array<double>")
    w, b = np.zeros(1 << BITS), 0.0
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((w, b, r))   # 2**BITS numbers each

        def advance(block: pa.Table, dual: pa.Table) -> pa.Table:
            w, b, r = shared.value
            block = block.sort_by([("fold", "ascending"), ("y", "ascending")])
            rows, y = [np.asarray(v.values.to_numpy()) for v in block.column("f")], block.column("y").to_numpy()
            old = np.asarray(dual.column("v")[0].values.to_numpy()) if dual.num_rows else np.zeros(len(y))
            new, weights, no = old.copy(), np.array(w), block.column("shard")[0].as_py()
            bias = descend(rows, y, r, np.where(y > 0, bound[1.0], bound[-1.0]), weights, b, new, EPOCHS // rounds, 5 + k)
            step = np.append(weights - w, bias - b) / shards
            at = [i for i in range(0, len(step), CHUNK) if step[i:i + CHUNK].any()]
            values = [old + (new - old) / shards, *[step[i:i + CHUNK] for i in at]]
            return pa.table({"shard": pa.array([no] * len(values), pa.int32()), "at": pa.array([-1, *at], pa.int32()),
                             "v": pa.array(values, pa.list_(pa.float64()))})

        out = materialise(dealt.groupBy("shard").cogroup(duals.groupBy("shard")).applyInArrow(advance, "shard int, at int, v array<double>"), "round")
        total = np.append(w, b)
        for c in out.filter("at >= 0").groupBy("at").applyInArrow(_add, "at int, v array<double>").collect():
            total[c["at"]:c["at"] + CHUNK] += c["v"]
        w, b, duals = total[:-1], float(total[-1]), out.filter("at < 0").select("shard", "v")
        shared.unpersist()
    dealt.unpersist()
    return w, b


def margins(rows: DataFrame, w: np.ndarray, b: float) -> DataFrame:
    """``y, z``: label and margin of ``rows`` (``y, f``)."""
    shared = rows.sparkSession.sparkContext.broadcast((w, b))   # 2**BITS numbers

    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            z = [w[np.asarray(v.values.to_numpy())].sum() + b for v in batch.column("f")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(z, pa.float64())], ["y", "z"])

    return rows.select("y", "f").mapInArrow(margin, "y double, z double")


def calibrate(rows: DataFrame, pos: int, neg: int, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of P(label 1 | margin) over ``rows`` (``y, z``),
    Newton with a small penalty; targets are smoothed by the class counts."""
    t, ab = F.when(F.col("y") > 0, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2)), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.col("z") * float(ab[0]) + float(ab[1]), F.lit(30.0)), F.lit(-30.0))))
        m = rows.select("z", (p - t).alias("d"), (p * (1 - p)).alias("h")).agg(
            F.sum(F.expr("h * z * z")), F.sum(F.expr("h * z")), F.sum("h"), F.sum(F.expr("d * z")), F.sum("d")).first()
        step = np.linalg.solve(np.array([[m[0], m[1]], [m[1], m[2]]]) + 1e-3 * np.eye(2), np.array(m[3:]) + 1e-3 * ab)
        ab -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]), float(ab[1])


def training_rows(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """``text, y, fold``: all labelled documents, one text (of smallest hash)
    of each id."""
    ids = labels.filter(keep & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_q"))
    x = docs.select("doc_id", "text").join(bounded_broadcast(ids, MAX_BROADCAST_IDS), F.col("doc_id") == F.col("_id"))
    text = F.coalesce("text", F.lit(""))
    x = x.groupBy("_id", "_q").agg(F.min(F.struct(F.xxhash64(text).alias("h"), text.alias("text"))).alias("t"))   # reduced where it is read
    return x.select("t.text", F.when(F.col("_q") > 0, 1.0).otherwise(-1.0).alias("y"), F.xxhash64(F.lit(3), "_id").alias("fold"))


def fit_quality(train: DataFrame, shard_features: int = SHARD_FEATURES) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias, slope and intercept, fitted on all rows of ``train``;
    counts of 2**BITS features and as many weights reach the driver."""
    rows = materialise(train.mapInArrow(_extract, "y double, fold long, f array<int>"), "features")
    rows = rows.withColumn("aside", F.col("fold") < ASIDE)
    size = {(x["aside"], x["y"]): (x["n"], x["f"]) for x in rows.groupBy("aside", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("f")).alias("f")).collect()}   # four rows at most
    classes = {y for _, y in size}
    if len(classes) < 2:
        return np.zeros(1 << BITS), 0.0, 0.0, 30.0 * sum(classes)
    apart = len(size) == 4                               # else both jobs take all rows
    fit, test = (rows.filter("NOT aside"), rows.filter("aside")) if apart else (rows, rows)

    def total(y: float, for_test: bool) -> np.ndarray:
        return np.sum([v for (aside, c), v in size.items() if c == y and (not apart or aside == for_test)], axis=0)

    n = {y: int(total(y, False)[0]) for y in classes}
    features = sum(int(total(y, False)[1]) for y in classes)
    bound = {y: COST * sum(n.values()) / (2.0 * n[y]) for y in classes}
    seen = fit.select("y", F.explode("f").alias("f")).groupBy("y", "f").agg(F.count(F.lit(1)).alias("n")).toArrow()   # 2 * 2**BITS rows at most
    count = np.zeros((2, 1 << BITS))
    count[(seen.column("y").to_numpy() > 0).astype(int), seen.column("f").to_numpy()] = seen.column("n").to_numpy()
    r = ratios(count)
    w, b = fit_weights(fit, r, bound, max(1, -(-features // shard_features)))
    w = w * r
    pos, neg = (int(total(y, True)[0]) for y in (1.0, -1.0))
    return w, b, *calibrate(materialise(margins(test, w, b), "margins"), pos, neg)


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float, float, float], name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (replaced, if there), the probability
    of label 1."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast((np.asarray(model[0], np.float64), *model[1:]))   # 2**BITS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b, a0, a1 = shared.value
        for batch in batches:
            data, off = text_buffers(batch.column("text"))
            parts = [np.zeros(0)]
            for i, j in slices(off):
                f, fo = features(data[off[i]:off[j]], off[i:j + 1] - off[i])
                total = np.concatenate([[0.0], np.cumsum(w[f])])
                parts.append(total[fo[1:]] - total[fo[:-1]] + b)
            s = 1 / (1 + np.exp(-np.clip(a0 * np.concatenate(parts) + a1, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, shard_features: int = SHARD_FEATURES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; documents
    whose crc32(id) mod 4 is 2 are held out of training."""
    model = fit_quality(training_rows(docs, labels, crc_mod(F.col("doc_id"), 4) != 2), shard_features)
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, shard_features: int = SHARD_FEATURES, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents the classifier rejects."""
    model = fit_quality(training_rows(docs, labels, crc_mod(F.col("doc_id"), 4) != 2), shard_features)
    name = free_name("score", docs.columns)
    return score_documents(docs, model, name).filter(F.col(name) >= threshold).select(*docs.columns)
