"""Merkle manifest of a dataset, with a proof for every document.

Each document is a leaf; per source the leaves, in the order of their ids,
are joined 16 at a time until one node is left (the subroot), and the
subroots, in the order of their sources, likewise give the root.

A tree's nodes are cut into aligned blocks of ``BLOCK`` (two levels).  A block
keeps a level as one string of hex digests; a parent is the hash of a
substring of 16 digests, and the siblings of a node are the two substrings
that flank it in its run.  The blocks' last nodes are the nodes of the next
round, so a source of any size is many small blocks, and the rounds shrink by
``BLOCK``.  On the way back each round hands the path above a block down to
its nodes.  Leaf places come from range partitioning (``number_rows``), so no
source is ever in one task.  DataFrame operations only.

Defined cases: a null field is ``-`` in the leaf, an empty text ``0:``; very
long texts are hashed whole; null ids come first, equal ids are ordered by
leaf (repeated rows are leaves of their own); a null id is never tampered
with; a null source is a tree of its own, before the others; a tree of one
leaf has no levels, and its proof without siblings is the hash of nothing; an
empty table gives no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.shared import materialise
from wardflow.operators.ranks import number_rows

ARITY = 16
BLOCK = ARITY * ARITY
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: every so many-th id (by CRC32) is tampered with
TAMPER_MOD = 5

PATH = "array<struct<l:string,r:string>>"


def digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Hash of the fields, each with its length in bytes."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(F.concat(*[part(c) for c in fields]))


def parents(level: Column) -> Column:
    """The next level of a block: hashes of runs of 16 digests."""
    runs = F.ceil(F.length(level) / (ARITY * HEX)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: digest(
        F.substring(level, i * (ARITY * HEX) + 1, F.lit(ARITY * HEX)))), "")


def flanks(level: Column, at: Column) -> Column:
    """What stands left and right of node ``at`` of a level in its run."""
    k = at % ARITY
    return F.struct(F.substring(level, (at - k) * HEX + 1, k * HEX).alias("l"),
                    F.substring(level, (at + 1) * HEX + 1, (F.lit(ARITY - 1) - k) * HEX).alias("r"))


def fold(path: Column, start: Column) -> Column:
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["l"], node, s["r"])))


def _blocks(nodes: DataFrame, name: str, *more: str) -> DataFrame:
    """``(tree, block, size, nodes, level, above, top)`` from nodes ``(tree,
    pos, size, hash, more...)``; ``size`` counts the tree's nodes."""
    one = F.struct("pos", "hash", *more)
    b = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "size").agg(F.array_sort(F.collect_list(one)).alias("nodes"))
    b = b.withColumn("level", F.array_join("nodes.hash", ""))
    b = b.withColumn("above", F.when(F.col("size") > 1, parents(F.col("level"))))
    b = b.withColumn("top", F.when(F.col("size") > ARITY, parents(F.col("above"))).otherwise(F.coalesce("above", "level")))
    return materialise(b, name)


def build_tree(nodes: DataFrame, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of all rounds, leaves first, and ``(tree, hash)`` of the roots."""
    rounds = [_blocks(nodes, "blocks", *more)]
    size = rounds[0].agg(F.max("size")).first()[0] or 0
    while True:
        tops = rounds[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("hash"))
        if size <= BLOCK:
            return rounds, tops.select("tree", "hash")
        size = -(-size // BLOCK)
        rounds.append(_blocks(tops, "blocks"))


def paths(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """``(tree, pos, node, path, ...)`` of every leaf: siblings of all its
    levels.  ``top``: ``(tree, path, ...)`` with the path above each root."""
    carried = [c for c in top.columns if c not in ("tree", "path")]
    above = top.select("tree", F.lit(0).cast("long").alias("pos"), *top.columns[1:])
    for blocks in reversed(rounds):
        up = above.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"), F.col("path").alias("up_path"), *carried)
        b = blocks.join(up, (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_pos")))
        x = b.select("tree", "size", "level", F.col("above").alias("next"), "up_path", *carried, F.posexplode("nodes").alias("at", "node"))
        first, second = flanks(F.col("level"), F.col("at")), flanks(F.col("next"), F.floor(F.col("at") / ARITY).cast("int"))
        own = (F.when(F.col("size") > ARITY, F.array(first, second)).when(F.col("size") > 1, F.array(first))
               .otherwise(F.array().cast(PATH)))
        above = x.select("tree", F.col("node.pos").alias("pos"), "node", F.concat(own, F.col("up_path")).alias("path"), *carried)
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``(doc_id, source_tree, leaf, subroot, root, path, seen_leaf)``: the
    whole manifest.  ``path`` lists the siblings, left and right, level by
    level up to the root; ``seen_leaf`` is the leaf of the row as found later,
    with ``tampered`` in place of the text (by default the row as it is)."""
    source = F.col("source").cast("string")
    fields = [F.col(c) for c in FIELDS]
    seen = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf([*fields[:-1], tampered]))
    rows = docs.select(F.when(source.isNull(), "").otherwise(F.concat(F.lit("s"), source)).alias("tree"), "doc_id",
                       leaf(fields).alias("hash"), seen.alias("seen"))
    rows = materialise(rows, "leaves")                   # hashed once; sampling the ranges reads the table
    rows = number_rows(rows, [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()], ["tree"], "pos", "size")
    rounds, roots = build_tree(rows, "doc_id", "seen")
    roots = materialise(roots, "subroots")
    upper = number_rows(roots.withColumn("source_tree", F.col("tree")), [F.col("source_tree").asc()], None, "pos", "size")
    upper_rounds, root = build_tree(upper.withColumn("tree", F.lit("")), "source_tree")
    found = root.first()
    top = root.select("tree", F.array().cast(PATH).alias("path"))
    above = paths(upper_rounds, top).select(F.col("node.source_tree").alias("tree"), "path", F.col("node.hash").alias("subroot"))
    leaves = paths(rounds, materialise(above, "above"))
    return leaves.select("node.doc_id", F.col("tree").alias("source_tree"), F.col("node.hash").alias("leaf"), "subroot",
                         F.lit(found[1] if found else None).cast("string").alias("root"), "path",
                         F.coalesce("node.seen", "node.hash").alias("seen_leaf"))


def verify(entries: DataFrame) -> DataFrame:
    """Digest of each proof, the root that the leaf as seen leads to, and
    whether it is the manifest's."""
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""))
    x = entries.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.col("path"), F.col("seen_leaf")).alias("folded_root"))
    return x.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_text() -> Column:
    """The tampering of the query: A-Z of the text of every fifth id in lower
    case; null where nothing changes hands."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MOD == 0
    return F.when(hit, F.translate("text", UPPER, LOWER))


def _levels_sql(prefix: str, start: str, levels: int) -> str:
    """CTEs ``{prefix}r0, {prefix}l1, {prefix}r1, ...``: runs and levels above
    ``start`` (tree, pos, hash); a tree with one node left stays as it is."""
    out, level = [], start
    for k in range(levels):
        out.append(f"{prefix}r{k} AS (SELECT tree, pos // {ARITY} AS run, list(hash ORDER BY pos) AS hs, max(n) AS n FROM "
                   f"(SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {level}) GROUP BY tree, run)")
        out.append(f"{prefix}l{k + 1} AS (SELECT tree, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS hash FROM {prefix}r{k})")
        level = f"{prefix}l{k + 1}"
    return ",\n".join(out)


def _climb_sql(prefix: str, runs: str, start: str, levels: int) -> str:
    """CTEs ``{prefix}1 ...``: proof and folded node of each row of ``start``
    (tree, pos, proof, node, ...), a level at a time."""
    out, level = [], start
    for k in range(levels):
        p = f"(d.pos % {ARITY})"
        left, right = f"array_to_string(hs[1:{p}], '')", f"array_to_string(hs[{p} + 2:], '')"
        out.append(f"{prefix}{k + 1} AS (SELECT d.* REPLACE (d.pos // {ARITY} AS pos, CASE WHEN n > 1 THEN proof || {left} || {right} ELSE proof END AS proof, "
                   f"CASE WHEN n > 1 THEN sha256({left} || node || {right}) ELSE node END AS node) FROM {level} d JOIN {runs}{k} r ON r.tree = d.tree AND r.run = d.pos // {ARITY})")
        level = f"{prefix}{k + 1}"
    return ",\n".join(out)


def merkle_sql(levels: int = 7) -> str:
    """The same rows in DuckDB SQL, for trees of up to 16**levels leaves."""
    def part(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join([part(c) for c in FIELDS[:-1]] + [part(text)]) + ")"

    shift = "SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM "
    table = "(SELECT i, i::BIGINT AS c FROM range(256) g(i))"
    for _ in range(8):
        table = f"({shift}{table})"
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)), "
           "lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)")
    return f"""
WITH crc AS (SELECT list(c ORDER BY i) AS tab FROM {table}),
x AS (SELECT *, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS tree, {hashed('text')} AS leaf,
        CASE WHEN {crc} % {TAMPER_MOD} = 0 THEN {hashed(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {hashed('text')} END AS seen FROM documents, crc),
s0 AS (SELECT tree, doc_id, leaf, seen, leaf AS hash, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM x),
{_levels_sql('s', 's0', levels)},
u0 AS (SELECT '' AS tree, tree AS source_tree, hash, row_number() OVER (ORDER BY tree) - 1 AS pos FROM sl{levels}),
{_levels_sql('u', 'u0', levels)},
d0 AS (SELECT tree, pos, '' AS proof, seen AS node, doc_id, leaf FROM s0),
{_climb_sql('d', 'sr', 'd0', levels)},
e0 AS (SELECT '' AS tree, u0.pos, proof, node, doc_id, leaf, u0.hash AS subroot FROM d{levels} d JOIN u0 ON u0.source_tree = d.tree),
{_climb_sql('e', 'ur', 'e0', levels)}
SELECT doc_id, leaf, subroot, ul{levels}.hash AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = ul{levels}.hash AS verified
FROM e{levels}, ul{levels}"""
