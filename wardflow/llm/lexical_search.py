"""Ranked lexical search with hashed max-sketches.

The index keeps one sketch per document: its terms are hashed to ``WIDTH``
coordinates, and each coordinate holds the largest impact of the terms that
fall on it, rounded up to a step.  A query's bound for a document is the sum,
over its terms, of weight times the sketch's value at the term's coordinate:
never less than the true score.  The bounds of a batch of documents and a
block of queries are one product of the sketches' used coordinates with the
queries' weights.

A search first rescores, exactly, the documents of each task's highest bounds
for each query; the k-th of their scores is the query's threshold.  Then each task goes through its
documents batch by batch and, per query, by descending bound, rescoring from
the whole text until the bound falls under the threshold, which rises with
the task's own k-th score.  A document is left out only if its bound is under
a score that k others reach.

Queries are taken in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_CHARS`` characters (a longer item is a block of its own), so what
tasks hold of them is bounded.  Sketches, term counts and corpus counts cover
all documents and whole texts; texts are tokenised piece by piece, so a task
holds a text and its distinct terms.

Defined cases: null and empty texts have no terms, count neither in N nor in
L and are never returned; very long texts are read whole; equal scores are
ranked by ascending document id, null ids last; repeated rows are documents
of their own; every benchmark row is a query, so repeated items repeat their
result, and a null or empty item has none; empty tables give no rows; extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.shared import materialise

#: coordinates of a sketch
WIDTH = 4096
#: impacts are below 1,000,000; a sketch rounds them up to a multiple of this, in one byte
STEP = 4096
PIECE_BYTES = 1 << 20
BLOCK_ITEMS, BLOCK_CHARS = 1000, 1_000_000
#: documents per task and query whose scores give the first threshold (too few of them: threshold 0)
SEEDS = 5
#: parts in which a query's rows are cut to k before they meet
CUTS = 16

_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term (UTF-8), piece by piece."""
    out: Counter = Counter()
    rest = b""
    for i in range(0, len(text), PIECE_BYTES):
        piece = rest + text[i:i + PIECE_BYTES].translate(_TERMS)
        cut = len(piece) if i + PIECE_BYTES >= len(text) else piece.rfind(b" ") + 1
        out.update(piece[:cut].split())
        rest = piece[cut:]
    return out


def coordinate(term: bytes, width: int) -> int:
    return zlib.crc32(term) % width


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 25 + (25 * n * n_docs) // n_terms


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _text(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def corpus_counts(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, list[int]]:
    """N, L, and the document count of each of ``terms``, summed in each task
    before they meet."""
    number = {t: i for i, t in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        df = np.zeros(len(number), np.int64)
        for b in batches:
            for t in b.column("text"):
                c = count_terms(t.as_py())
                n_docs += bool(c)
                n_terms += c.total()
                df[[number[t] for t in number.keys() & c.keys()]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], at])), pa.array(np.concatenate([[n_docs, n_terms], df[at]]))], ["term", "n"])

    rows = _text(docs, "doc_id").select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    found = {r[0]: r[1] for r in rows}
    return found.get(-2, 0), found.get(-1, 0), [found.get(i, 0) for i in range(len(terms))]


def build_index(docs: DataFrame, n_docs: int, n_terms: int, doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``(doc_id, n, text, sketch)`` of every document with a term, as a table
    in the shared folder.  The sketch is one byte per coordinate."""
    d = _text(docs, doc_id)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, length, sketches = [], [], []
            for i, t in enumerate(b.column("text")):
                c = count_terms(t.as_py())
                if not c:
                    continue
                n = c.total()
                tf = np.fromiter(c.values(), np.int64, len(c))
                value = -(-((1_000_000_000 * tf) // (1000 * tf + 12 * length_part(n, n_docs, n_terms))) // STEP)
                at = np.fromiter(map(zlib.crc32, c), np.int64, len(c)) % width
                s = np.zeros(width, np.uint8)
                np.maximum.at(s, at, value.astype(np.uint8))
                keep.append(i)
                length.append(n)
                sketches.append(s.tobytes())
            kept = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), pa.array(length, pa.int64()), kept.column("text"),
                                              pa.array(sketches, pa.binary())], ["doc_id", "n", "text", "sketch"])

    id_type = d.schema["doc_id"].dataType.simpleString()
    return materialise(d.mapInArrow(fold, f"doc_id {id_type}, n long, text binary, sketch binary"), "sketches", {"compression": "zstd"})


class Block:
    """Queries of a block: weights of their terms, and the matrix that turns
    the used coordinates of a sketch into bounds."""

    def __init__(self, queries: list[Counter], terms: list[bytes], df: list[int], n_docs: int, n_terms: int, width: int = WIDTH):
        self.n_docs, self.n_terms, self.width = n_docs, n_terms, width
        w = {t: weight(n_docs, n) for t, n in zip(terms, df) if n}
        self.terms = [[(t, w[t] * c) for t, c in q.items() if w.get(t)] for q in queries]
        self.vocabulary = set(w)
        self.matrix = None

    def _prepare(self) -> None:
        self.used = sorted({coordinate(t, self.width) for q in self.terms for t, _ in q})
        place = {c: i for i, c in enumerate(self.used)}
        self.matrix = np.zeros((len(self.used), len(self.terms)))
        for k, q in enumerate(self.terms):
            for t, x in q:
                self.matrix[place[coordinate(t, self.width)], k] += x * STEP

    def bounds(self, sketches: pa.Array) -> np.ndarray:
        """Documents by queries; sums of integers below 2**53, so exact."""
        if self.matrix is None:                          # made in the task, not sent to it
            self._prepare()
        raw = np.frombuffer(b"".join(s.as_py() for s in sketches), np.uint8).reshape(-1, self.width)
        return raw[:, self.used].astype(np.float64) @ self.matrix

    def counted(self, text: pa.Scalar, n: pa.Scalar) -> tuple[dict[bytes, int], int]:
        """What a document's scores need: its counts of the block's terms, and m."""
        c = count_terms(text.as_py())
        return {t: c[t] for t in c.keys() & self.vocabulary}, length_part(n.as_py(), self.n_docs, self.n_terms)

    def score(self, k: int, counts: dict[bytes, int], m: int) -> int:
        return sum(x * impact(counts[t], m) for t, x in self.terms[k] if t in counts)


def _order(score: int, doc_id) -> tuple:
    """Sorts the better document higher; works for any id type."""
    return (score, doc_id is not None, _Reversed(doc_id))


class _Reversed:
    __slots__ = ("x",)

    def __init__(self, x):
        self.x = x

    def __lt__(self, other) -> bool:
        return self.x is not None and other.x is not None and other.x < self.x

    def __eq__(self, other) -> bool:
        return self.x == other.x


def _search(block: Block, floors: list[int], k: int, seeds_only: bool):
    """The task's k best documents per query, exactly scored.  With
    ``seeds_only`` just the documents of the task's ``SEEDS`` highest bounds
    are rescored: the k-th of all their scores is a threshold for the search."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list] = [[] for _ in block.terms]      # heaps of (bound, document, score)
        no = 0
        for b in batches:
            bounds, counted = block.bounds(b.column("sketch")), {}
            take = min(SEEDS, len(bounds))
            for q in range(len(top)):
                for i in np.argpartition(-bounds[:, q], take - 1)[:take].tolist() if take else []:
                    if bounds[i, q] > (top[q][0][0] if len(top[q]) == SEEDS else 0):
                        if i not in counted:
                            counted[i] = block.counted(b.column("text")[i], b.column("n")[i])
                        row = (bounds[i, q], no + i, block.score(q, *counted[i]))
                        (heapq.heappush if len(top[q]) < SEEDS else heapq.heapreplace)(top[q], row)
            no += len(bounds)
        yield _batch([(q, d, s) for q, rows in enumerate(top) for _, d, s in rows], pa.int64())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list] = [[] for _ in block.terms]      # heaps of (order, doc_id, score)
        floor = np.array(floors, np.float64)
        id_type, serial = pa.int64(), 0
        for b in batches:
            id_type = b.column("doc_id").type
            ids, bounds = b.column("doc_id"), block.bounds(b.column("sketch"))
            counted: dict[int, tuple] = {}
            open_ = (bounds >= floor) & (bounds > 0)
            for q in np.flatnonzero(open_.any(axis=0)):
                rows = np.flatnonzero(open_[:, q])
                for i in rows[np.argsort(-bounds[rows, q], kind="stable")]:
                    if bounds[i, q] < floor[q]:
                        break
                    i = int(i)
                    if i not in counted:
                        counted[i] = block.counted(b.column("text")[i], b.column("n")[i])
                    s = block.score(q, *counted[i])
                    if s <= 0 or s < floor[q]:
                        continue
                    doc_id = ids[i].as_py()
                    row = (_order(s, doc_id), serial, doc_id, s)
                    serial -= 1
                    if len(top[q]) < k:
                        heapq.heappush(top[q], row)
                    else:
                        heapq.heappushpop(top[q], row)
                    if len(top[q]) == k:
                        floor[q] = max(floor[q], top[q][0][3])
        yield _batch([(q, d, s) for q, rows in enumerate(top) for _, _, d, s in rows], id_type)

    return seeds if seeds_only else search


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
                                       pa.array([r[2] for r in rows], pa.int64())], ["q", "doc_id", "score"])


def _blocks(benchmark: DataFrame, item_id: str) -> Iterator[list[tuple]]:
    """Blocks of (item id, text) of the benchmark, one at a time."""
    block, chars = [], 0
    for r in benchmark.select(F.col(item_id), F.coalesce(F.col("text"), F.lit(""))).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(r[1]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((r[0], r[1]))
        chars += len(r[1])
    if block:
        yield block


def _k_best(found: DataFrame, k: int, *order) -> DataFrame:
    """The k first rows of each query, cut in parts before they meet."""
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(CUTS))
    first = found.withColumn("at", F.row_number().over(Window.partitionBy("q", part).orderBy(*order))).filter(F.col("at") <= k).drop("at")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


def search(docs: DataFrame, benchmark: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id",
           width: int = WIDTH) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of every item.
    ``width``, the coordinates of a sketch, tells speed only."""
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    item_type = benchmark.schema[item_id].dataType.simpleString()
    schema = f"q int, doc_id {id_type}, score long"
    by_rank = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    index, parts = None, []
    for block in _blocks(benchmark, item_id):
        queries = [count_terms(t.encode()) for _, t in block]
        terms = sorted(set().union(*queries))
        n_docs, n_terms, df = corpus_counts(docs, terms)
        if index is None:
            index = build_index(docs, n_docs, n_terms, doc_id, width)
        prepared = Block(queries, terms, df, n_docs, n_terms, width)
        seeds = index.select("doc_id", "n", "text", "sketch").mapInArrow(_search(prepared, [], k, True), "q int, doc_id long, score long")
        last = _k_best(seeds, k, F.col("score").desc()).filter(F.col("rank") == k).select("q", "score").collect()
        floors = [0] * len(block)
        for q, s in last:                                # one row per query of the block
            floors[q] = s
        found = materialise(index.mapInArrow(_search(prepared, floors, k, False), schema), "found")
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, item_id {item_type}")
        parts.append(_k_best(found, k, *by_rank).join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SEARCH_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM benchmark),
g AS (SELECT count(*) AS n_docs, sum(len(l)) AS n_terms FROM t WHERE len(l) > 0),
m AS (SELECT row, doc_id, 75 + ((25 * len(l)::BIGINT * n_docs) // n_terms::BIGINT) AS m FROM t, g WHERE len(l) > 0),
q AS (SELECT item, item_id, unnest(l) AS term FROM i),
f AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(l) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY term, n_docs),
s AS (SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL HAVING score > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20"""
