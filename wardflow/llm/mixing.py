"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson-distributed number of times whose mean
is the target repetition rate of its source: the source's share of the target
size divided by its present size.  The count inverts the Poisson distribution
at a draw seeded by the document's id and text, so it needs no coordination
between tasks and is the same after a retry; copies are dealt over the cluster
by a second draw and sorted by it, a global shuffle.  Rows repeated with one id
and text share their draws; the row's place in the input joins the second one
where copies are dealt, so they are spread like all others.

Defined cases: a null source is a source of its own; null text has size 0; a
null id is an id like others; rows repeated with one id and text get the same
count; very long texts are carried whole; a source that is not in ``weights``
(or has weight 0) gets rate 0; a source without any text has rate 1, as no
rate changes its size; an empty table stays empty.  Extra columns, whatever
their names, are carried along (``copy_no`` and ``shuffle_key`` are added;
columns of those names in the input are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.shared import bounded_broadcast, materialise, uniform

#: a rate above this is drawn as a sum of independent Poisson counts
PIECE = 32.0
#: terms of the distribution function of one piece; beyond, the tail is below 2**-53
TERMS = 120
#: sources up to this many are broadcast; more are joined by a shuffle
MAX_BROADCAST_SOURCES = 100_000


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                 target_size: float | None = None, source: str = "source", size: Column | None = None) -> DataFrame:
    """``(source, size, rate)``: mean repetitions per source.

    ``weights`` gives target shares by source (normalised); without it, a
    source's weight is its size to the power ``temperature``.  ``target_size``
    is the size of the mixture, by default that of the weighted sources.
    ``size`` is a document's size, by default its characters."""
    size = F.coalesce(F.length("text"), F.lit(0)) if size is None else size
    s = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size.cast("double")).alias("size"))
    if weights is None:
        w = F.pow("size", F.lit(float(temperature)))
    else:
        w = F.lit(0.0)
        for name, x in weights.items():
            w = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(x))).otherwise(w)
    s = materialise(s.withColumn("weight", w), "sources")
    used = s.filter("weight > 0")
    total = used.agg(F.sum("weight").alias("w"), F.sum("size").alias("t"))
    goal = F.lit(float(target_size)) if target_size is not None else total.select("t").scalar()
    rate = F.col("weight") / total.select("w").scalar() * goal / F.col("size")
    return s.select("source", "size", F.when(F.col("size") == 0, 1.0).when(F.col("weight") > 0, rate)
                    .otherwise(0.0).alias("rate"))


def distribution(rate: Column) -> Column:
    """Values P(X <= k), k = 0..TERMS, of a Poisson variable of mean ``rate``."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("s"), F.array(F.exp(-rate)).alias("a")),
        lambda x, k: F.struct((x["p"] * rate / k).alias("p"), (x["s"] + x["p"] * rate / k).alias("s"),
                              F.concat(x["a"], F.array(x["s"] + x["p"] * rate / k)).alias("a")))
    return step["a"]


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                target_size: float | None = None, seed: int = 17, source: str = "source",
                doc_id: str = "doc_id") -> DataFrame:
    """The mixed and shuffled table: the columns of ``docs``, ``copy_no``
    (from 1) and ``shuffle_key``, sorted by the latter in each partition."""
    docs = docs.drop("copy_no", "shuffle_key")
    rates = source_rates(docs, weights, temperature, target_size, source)
    pieces = F.greatest(F.ceil(F.col("rate") / F.lit(PIECE)), F.lit(1)).cast("int")
    table = materialise(rates.select(F.col("source").alias("name"), pieces.alias("pieces"), distribution(F.col("rate") / pieces).alias("cdf")), "rates")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(source).alias("of"), F.col(doc_id).alias("id"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), F.monotonically_increasing_id().alias("salt"))
    d = rows.join(bounded_broadcast(table, MAX_BROADCAST_SOURCES), F.col("of").eqNullSafe(F.col("name")))
    count = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: uniform(seed, F.col("id"), F.col("text_md5"), i)),
        F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    d = d.withColumn("copies", count).filter("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.floor(uniform(seed + 1, F.col("id"), F.col("text_md5"), F.col("copy_no")) * F.lit(float(1 << 52))).cast("long")
    d = d.select("row", "copy_no", key.alias("shuffle_key"), "salt")
    return (d.repartition("shuffle_key", "salt").sortWithinPartitions("shuffle_key", "salt")
            .select("row.*", "copy_no", "shuffle_key"))


def mix_sql(temperature: float = 0.5, seed: int = 17) -> str:
    """The same mixture in DuckDB SQL, over table ``documents``."""
    u = "('0x' || substr(md5('{s}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, '')) || '|' || {i}), 1, 13))::BIGINT"
    return f"""
WITH s AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source),
r AS (SELECT source, CASE WHEN size = 0 THEN 1 ELSE pow(size, {temperature})
        / (SELECT sum(pow(size, {temperature})) FROM s WHERE size > 0) * (SELECT sum(size) FROM s) / size END AS rate FROM s),
p AS (SELECT source, rate, greatest(ceil(rate / {PIECE}), 1)::INT AS pieces FROM r),
t AS (SELECT source, pieces, k, sum(exp(k * ln(rate / pieces) - rate / pieces - lgamma(k + 1)))
        OVER (PARTITION BY source ORDER BY k) AS cdf FROM p, range(0, {TERMS + 1}) g(k)),
c AS (SELECT source, pieces, list(cdf ORDER BY k) AS cdf FROM t GROUP BY source, pieces),
d AS (SELECT d.*, list_sum([len(list_filter(c.cdf, lambda x: x <= {u.format(s=seed, i='i')} / {float(1 << 52)}))
        for i in range(0, c.pieces)]) AS n
      FROM documents d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT * EXCLUDE (n), {u.format(s=seed + 1, i='copy_no')} AS shuffle_key
FROM (SELECT *, unnest(range(1, n::BIGINT + 1))::INT AS copy_no FROM d) x"""

