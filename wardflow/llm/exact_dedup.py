"""Exact dedup with an extendible-hash index kept in shared files.

Texts are equal when identical after replacing each run of white space by
one space.  A text's key is the first 60 bits of its SHA-256.  The directory
starts as one bucket and doubles until no bucket holds more than
``capacity`` distinct texts (or its keys can't be told apart): a table of key
prefixes, split level by level from counts of distinct keys.  It also deals
the work: contiguous buckets are packed, by their counts, into one owner task
each; owners take whole buckets, in key order, chain texts that share a key
and tell them apart by comparing their bytes.

Copies are combined where they are read, over ``CACHE_BYTES`` of the texts
seen last, so a text that makes up a large part of the table reaches its owner
about once per partition.  Entries and directory are Parquet tables in the
cluster's shared folder.

Defined cases: null text is the empty text; very long texts are compared
whole; a null ``doc_id`` sorts after all others (``keep_id`` is null only if
all ids of a group are); of rows repeated with one id and text exactly one
stays; an empty table gives no rows; extra columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.shared import SPACE, bounded_broadcast, materialise
from wardflow.operators.ranks import running

KEY_BITS = 60
#: distinct texts of a bucket before it is split; about 100 MB of text at 3 kB each
CAPACITY = 32_768
#: directory slots up to this many are broadcast; more are joined by a shuffle
MAX_BROADCAST_SLOTS = 1_000_000
#: texts in which a task looks for copies before it sends them on
CACHE_BYTES = 32 << 20
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2048


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _key(sha: Column) -> Column:
    return F.conv(F.substring(sha, 1, KEY_BITS // 4), 16, 10).cast("long")


@dataclass
class ExactIndex:
    """``rows``: (doc_id, row_no, sha, key) of every input row;
    ``entries``: (bucket, key, chain_no, sha, keep_id, group_size), one per
    distinct text; ``directory``: (prefix, local_depth, bucket, owner)."""

    rows: DataFrame
    entries: DataFrame
    directory: DataFrame
    depth: int


def split_directory(counts: DataFrame, bits: int, capacity: int) -> DataFrame:
    """Buckets ``(start, local_depth, n)`` from counts ``(p, n)`` of distinct
    keys per prefix of ``bits`` bits: a bucket that holds more than
    ``capacity`` gives way to its two halves, at most ``bits`` times.
    ``start`` is the bucket's first prefix of ``bits`` bits."""
    each = counts.select("n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("d"), "p")
    nodes = each.groupBy("d", F.expr(f"shiftright(p, {bits} - d)").alias("p")).agg(F.sum("n").alias("n"))
    full = nodes.filter((F.col("n") > capacity) & (F.col("d") < bits))
    halves = full.select((F.col("d") + 1).alias("hd"), F.explode(F.array(F.col("p") * 2, F.col("p") * 2 + 1)).alias("hp"))
    root = counts.sparkSession.range(1).select(F.lit(0).alias("hd"), F.lit(0).cast("long").alias("hp"))
    found = root.unionByName(halves).join(nodes, (F.col("hd") == F.col("d")) & (F.col("hp") == F.col("p")), "left")
    found = found.select(F.col("hd").alias("local_depth"), F.col("hp"), F.coalesce("n", F.lit(0)).alias("n"))
    leaves = found.filter((F.col("n") <= capacity) | (F.col("local_depth") == bits))
    return leaves.select(F.expr(f"shiftleft(hp, {bits} - local_depth)").alias("start"), "local_depth", "n")


def pack_owners(buckets: DataFrame, owners: int) -> DataFrame:
    """``buckets`` with ``owner``: contiguous buckets of about equal counts."""
    b = running(buckets, [F.col("start").asc()], {"upto": ("sum", "n")})
    total = b.agg(F.max("upto").alias("t")).select("t").scalar()
    share = F.greatest(F.ceil(total / F.lit(owners)), F.lit(1))
    return b.withColumn("owner", F.floor((F.col("upto") - F.col("n")) / share).cast("int")).drop("upto")


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies among the texts seen last become one row: smallest id and
    count.  What falls out of the cache, and the rest at the end, is sent on."""
    seen: OrderedDict[str, list] = OrderedDict()         # sha: [key, text, smallest id, rows]
    held = 0
    out: list[list] = []
    size = 0

    def batch() -> pa.RecordBatch:
        nonlocal out, size
        cols = list(zip(*[(e[0], s, e[1], e[2], e[3]) for s, e in out]))
        out, size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                          ["key", "sha", "norm", "doc_id", "n"])

    for b in batches:
        for key, sha, text, doc_id in zip(*[b.column(c).to_pylist() for c in ("key", "sha", "norm", "doc_id")]):
            e = seen.get(sha)
            if e is not None and e[1] == text:
                e[2] = doc_id if e[2] is None else e[2] if doc_id is None else min(e[2], doc_id)
                e[3] += 1
                seen.move_to_end(sha)
                continue
            if e is not None:                            # another text of this hash
                out.append((sha, seen.pop(sha)))
                held -= len(e[1])
                size += len(e[1])
            seen[sha] = [key, text, doc_id, 1]
            held += len(text)
            while held > CACHE_BYTES and len(seen) > 1:
                old, e = seen.popitem(last=False)
                held -= len(e[1])
                size += len(e[1])
                out.append((old, e))
                if size > BATCH_BYTES or len(out) >= BATCH_ROWS:
                    yield batch()
    for old, e in seen.items():
        out.append((old, e))
        size += len(e[1])
        if size > BATCH_BYTES or len(out) >= BATCH_ROWS:
            yield batch()
    if out:
        yield batch()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner task: rows in key order; one entry per distinct text.  Holds the
    chain of the current key only."""
    names = ["bucket", "key", "chain_no", "sha", "keep_id", "group_size"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    now, chain = None, []          # entries: [bytes, sha, smallest id, rows]
    out: list[tuple] = []

    def close() -> None:
        out.extend((now[0], now[1], i, e[1], e[2], e[3]) for i, e in enumerate(chain))

    def batch() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
        out.clear()
        return done

    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("bucket", "key", "sha", "doc_id", "n")]
        text = b.column("norm")
        for i, (bucket, key, sha, doc_id, n) in enumerate(zip(*cols)):
            if now != (bucket, key):
                if now:
                    close()
                now, chain = (bucket, key), []
            value = text[i].as_buffer()
            for e in chain:
                if e[0].equals(value):
                    e[2] = doc_id if e[2] is None else e[2] if doc_id is None else min(e[2], doc_id)
                    e[3] += n
                    break
            else:
                chain.append([value, sha, doc_id, n])
        chain = [[pa.py_buffer(e[0].to_pybytes()), *e[1:]] for e in chain]  # doesn't hold on to the batch
        yield batch()
    if now:
        close()
        yield batch()


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> ExactIndex:
    d = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    d = d.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("key", _key(F.col("sha")))
    rows = materialise(d.select("doc_id", F.monotonically_increasing_id().alias("row_no"), "sha", "key"), "rows")
    total = rows.count()
    bits = max(1, (2 * total // capacity + 1).bit_length() + 2)
    # distinct keys per prefix: copies don't fill a bucket
    counts = rows.select("key").distinct().groupBy(F.shiftright("key", KEY_BITS - bits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    buckets = split_directory(materialise(counts, "counts"), bits, capacity)
    owners = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * total // capacity)
    buckets = materialise(pack_owners(materialise(buckets, "buckets"), owners), "packed")
    depth, last = buckets.agg(F.max("local_depth"), F.max("owner")).first()
    # the directory proper: each prefix of the global depth with its bucket
    slot = F.explode(F.sequence(F.shiftright("start", bits - depth), F.shiftright("start", bits - depth) + F.expr(f"shiftleft(1L, {depth} - local_depth)") - 1))
    directory = materialise(buckets.select(slot.alias("prefix"), "local_depth", F.col("start").alias("bucket"), "owner"), "directory")
    combined = d.mapInArrow(_combine, "key long, sha string, norm string, doc_id long, n long")
    own = F.shiftright("key", KEY_BITS - depth) if depth else F.lit(0).cast("long")
    owned = (combined.join(bounded_broadcast(directory.select("prefix", "bucket", "owner"), MAX_BROADCAST_SLOTS), own == F.col("prefix"))
             .repartitionById(last + 1, "owner").sortWithinPartitions("key"))
    entries = owned.select("bucket", "key", "sha", "norm", "doc_id", "n").mapInArrow(
        _chain, "bucket long, key long, chain_no int, sha string, keep_id long, group_size long")
    return ExactIndex(rows, materialise(entries, "entries"), directory, depth)


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256`` and the index position ``bucket, chain_no``."""
    x = build_index(docs, capacity)
    first = x.rows.groupBy("key", "sha").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"))["row_no"].alias("keep_row"))
    e = x.entries.join(first, ["key", "sha"])
    return x.rows.join(e, ["key", "sha"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"), "bucket", "chain_no")


EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
        row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS pos
      FROM d WINDOW w AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, pos = 1 AS kept, text_sha256 FROM r"""
