"""N-gram Jaccard join: pairs of documents whose sets of five-word shingles
have Jaccard similarity 0.8 or more, found by MinHash banding and verified
exactly.

This is banding, not an LSH forest: each of ``TREES`` bands (called tries
below) has as many MinHash values as ``prefix_depth`` computes from threshold
and target recall, at most ``MAX_DEPTH`` (6 with the given constants), hashed
to one key.  No prefix depends on the data; the documents of one key are
candidates.

Copies (equal word sequences) are one node of the join.  A band's key of many
documents is split into blocks, and pairs of blocks are verified in separate
tasks; a task compares its documents by a product of their incidence
matrices, block of shingles by block, and returns one row per document: the
number of its links and the smallest document linked to it there.  Pairs are
never rows.  A pair that meets in several tries is counted in the first.
Classes are the connected components of the links.

Words are case-sensitive runs of characters other than white space.  Defined
cases: null or blank text has no shingles and no links; a text of fewer than
five words has one shingle, all its words; rows repeated with one id and text
are copies of each other; a null doc_id never is a class id unless all ids of
the class are null; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.graph import components
from wardflow.llm.shared import materialise
from wardflow.llm.tokens import LANES, Words, mix, shingles, slices, text_buffers

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.999
TREES, MAX_DEPTH = 24, 10
#: documents of a block; a task holds two blocks
BLOCK = 256
#: cells of an incidence matrix at a time
CELLS = 1 << 23
SEED = 20240229


def prefix_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, max_depth: int = MAX_DEPTH) -> int:
    """Most values of a band at which documents at the threshold meet in at
    least one of the bands with the target recall."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def _signer(width: int, trees: int, depth: int):
    rng = np.random.default_rng(SEED)
    flip = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
    odd = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32) | np.uint32(1)
    lane = np.uint64(LANES[3])

    def keys(s: np.ndarray, off: np.ndarray) -> np.ndarray:
        """A key per document and trie: the hash of its leading values."""
        x = (s >> np.uint64(32)).astype(np.uint32)
        out = np.zeros((trees, len(off) - 1), np.uint64)
        for t in range(trees):
            for j in range(t * depth, (t + 1) * depth):
                out[t] = mix(out[t] * lane + np.minimum.reduceat((x ^ flip[j]) * odd[j], off[:-1]).astype(np.uint64))
        return out.view(np.int64).T

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off):
                w = Words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                h, n = w.hashes(), np.diff(w.doc)
                some = n > 0
                place = np.arange(len(h)) - np.repeat(w.doc[:-1], n)
                sid = np.zeros((j - i, 2), np.uint64)
                key = np.zeros((j - i, trees), np.int64)
                if some.any():
                    for k, c in enumerate((LANES[0], LANES[1])):  # hash of the word sequence
                        v = mix(h * np.uint64(c) + mix(place.astype(np.uint64) + np.uint64(c)))
                        sid[some, k] = mix(np.add.reduceat(v, w.doc[:-1][some]))
                    s, so = shingles(h, w.doc, width)
                    key[some] = keys(s, np.concatenate([so[:-1][some], so[-1:]]))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * trees, trees), pa.int32()), pa.array(key.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("tkey").slice(i, j - i), pa.array(n.astype(np.int32)),
                     pa.array([r.tobytes() for r in sid], pa.binary()), lists], ["doc_id", "tkey", "n_words", "sid", "keys"])

    return sign


def _links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs at or above the threshold."""
    size = np.array([len(s) for s in sets])
    n = len(sets)
    if n == 2:
        both = np.full((2, 2), len(np.intersect1d(sets[0], sets[1], assume_unique=True)))
    else:
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(n), size)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        both, step = np.zeros((n, n), np.float64), max(1, CELLS // n)
        for a in range(0, len(values), step):
            lo, hi = np.searchsorted(code, [a, a + step])
            m = np.zeros((n, min(step, len(values) - a)), np.float32)
            m[row[lo:hi], code[lo:hi] - a] = 1
            both += m @ m.T
    union = size[:, None] + size[None, :] - both
    return both >= threshold * union - 1e-9


def _verify(width: int, threshold: float):
    def tile(rows: dict, sets: list[np.ndarray], at: np.ndarray) -> tuple[list, list, list]:
        sid = [rows["sid"][i] for i in at]
        firsts = dict((s, k) for k, s in reversed(list(enumerate(sid))))       # repeated rows once
        own = sorted(firsts.values())
        at, sid = at[own], [sid[k] for k in own]
        tree = rows["tree"][at[0]]
        hit = _links([sets[i] for i in at], threshold)
        np.fill_diagonal(hit, False)
        if rows["i"][at[0]] != rows["j"][at[0]]:
            block = rows["block"][at]
            hit &= block[:, None] != block[None, :]
        keys = rows["keys"][at]
        for t in range(tree):
            hit &= keys[:, t][:, None] != keys[:, t][None, :]
        rank = np.argsort(np.argsort(np.array(sid, dtype=object)))
        label = rank.copy()
        while True:
            new = np.minimum(label, np.where(hit, label[None, :], len(sid)).min(axis=1))
            if (new == label).all():
                break
            label = new
        by_rank = sorted(sid)
        some = hit.any(axis=1)
        return ([s for s, x in zip(sid, some) if x], (hit @ rows["n"][at])[some].tolist(),
                [by_rank[k] for k, x in zip(label, some) if x])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(t: pa.Table) -> pa.RecordBatch:
            n = t.num_rows
            rows = {c: t.column(c).to_numpy() for c in ("tile", "tree", "i", "j", "block", "n")}
            rows["sid"] = t.column("sid").to_pylist()
            keys = t.column("keys").combine_chunks()
            rows["keys"] = keys.flatten().to_numpy().reshape(n, -1)
            data, off = text_buffers(t.column("text"))
            sets: list[np.ndarray] = []
            for a, b in slices(off):
                w = Words(data[off[a]:off[b]], off[a:b + 1] - off[a])
                s, so = shingles(w.hashes(), w.doc, width)
                sets += [np.unique(s[so[d]:so[d + 1]]) for d in range(b - a)]
            out: tuple[list, list, list] = ([], [], [])
            cut = np.flatnonzero(np.diff(rows["tile"], prepend=rows["tile"][0] - 1))
            for a, b in zip(cut, [*cut[1:], n]):
                if b - a > 1:
                    for o, x in zip(out, tile(rows, sets, np.arange(a, b))):
                        o.extend(x)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                                              ["sid", "links", "root"])

        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            tiles = t.column("tile").to_numpy()
            end = int(np.searchsorted(tiles == tiles[-1], True)) if len(tiles) else 0
            if end:
                yield run(t.slice(0, end))
            rest = t.slice(end)
        if rest is not None and rest.num_rows:
            yield run(rest)

    return verify


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
                    trees: int = TREES) -> DataFrame:
    """One row per input row: ``doc_id, tkey`` (hash of the text),
    ``class_id`` (smallest doc_id of the class), ``n_links`` (rows linked to
    this one, copies included), ``class_size`` and ``stays`` (true for all
    rows with the class's first doc_id and text)."""
    depth = prefix_depth(threshold, recall, trees)
    d = docs.select("doc_id", _text_key(F.col("text")).alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    signed = materialise(d.mapInArrow(_signer(width, trees, depth),
                                      "doc_id long, tkey long, n_words int, sid binary, keys array<long>"), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey", "keys")).alias("f")
    nodes = materialise(signed.filter("n_words > 0").groupBy("sid").agg(F.count(F.lit(1)).alias("n"), first)
                        .select("sid", "n", "f.*"), "nodes")
    spots = nodes.select("sid", F.posexplode("keys").alias("tree", "key"))
    # trie nodes of the same documents hold the same pairs: the first is enough
    who = [F.bit_xor(F.xxhash64(F.lit(k), F.col("sid"))).alias(f"who{k}") for k in (0, 1)]
    shared = spots.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("size"), *who).filter("size > 1")
    shared = shared.groupBy("size", "who0", "who1").agg(F.min(F.struct("tree", "key")).alias("t")).select("t.tree", "t.key", "size")
    members = (spots.join(shared, ["tree", "key"]).groupBy("sid")
               .agg(F.collect_list(F.struct("tree", "key", "size")).alias("spots")))   # one per trie at most
    members = materialise(members, "members")
    m = members.join(nodes, "sid").select("sid", "n", F.col("doc_id").alias("md"), F.col("tkey").alias("mt"), "keys", "spots")
    texts = d.join(m, F.col("doc_id").eqNullSafe(F.col("md")) & (F.col("tkey") == F.col("mt")))
    # rows repeated with the node's id and text give its text once, reduced where they are read
    texts = texts.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "keys", "text", "spots")])
    blocks = F.ceil(F.col("s.size") / F.lit(BLOCK)).cast("int")
    x = texts.select("sid", "n", "keys", "text", F.explode("spots").alias("s"))
    x = x.withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    x = x.select("sid", "n", "keys", "text", "s.tree", "s.key", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    x = x.withColumn("tile", F.xxhash64("tree", "key", "i", "j"))
    found = materialise(x.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        _verify(width, threshold), "sid binary, links long, root binary"), "links")
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    named = (nodes.select("sid", "n", "no_id", "doc_id", "tkey").join(links, "sid", "left")
             .join(labels.withColumnRenamed("node", "sid"), "sid", "left")
             .select("sid", "n", "no_id", "doc_id", "tkey", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "sid").alias("label")))
    named = materialise(named, "named")
    classes = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"),
                                         F.min(F.struct("no_id", "doc_id", "tkey")).alias("first"))
    of = named.join(classes, "label").select("sid", "class_id", "class_size", "first", (F.col("links") + F.col("n") - 1).alias("n_links"))
    own = signed.join(of, "sid", "left")      # the smallest of a class may be a copy of another node: compare rows, not nodes
    empty = F.col("n_words") == 0
    return own.select("doc_id", "tkey", F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(empty, 0).otherwise(F.col("n_links")).alias("n_links"),
                      F.when(empty, 1).otherwise(F.col("class_size")).alias("class_size"),
                      (empty | (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.tkey") == F.col("tkey")))).alias("stays"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class, the one of smallest doc_id;
    of rows repeated with its id and text the one whose columns sort first
    stays, rows without words all stay."""
    columns = docs.columns
    keep = near_duplicates(docs, **options).filter("stays").select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_t"), (F.col("class_size") > 1).alias("_in")).distinct()
    row = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("_id"), _text_key(F.col("text")).alias("_key"))
    kept = row.join(keep, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_t")))
    once = kept.filter("_in").groupBy("_id", "_key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.union(kept.filter("NOT _in").select("row")).select("row.*")
