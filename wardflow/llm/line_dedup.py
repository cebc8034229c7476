"""Line dedup: later copies of repeated line runs are deleted.

A run of consecutive lines (blank lines apart) that occurs again later, in the
order of (doc_id, text, line), is deleted there if it has at least
``min_words`` words.  The runs come from a suffix array over the sequences of
line ids, built by distributed prefix doubling:

1. Lines that occur once can't be part of a repeated run; they cut the
   documents into sequences of repeated lines.  A line's id is its place in
   the sorted table of repeated lines.
2. Doubling: the rank of a suffix by its first 2k lines is the place of its
   pair (rank by k lines, rank by k lines of the suffix k lines on) in the
   sorted table of the distinct pairs.  Pairs are counted before they are
   sorted, so a line or pair that holds a large part of all rows is one row of
   that table, and sorting is by range.  Suffixes whose pair occurs once have
   no longer repetition and leave the array.  A blank-free run of
   ``min_words`` words has at most that many lines, so rounds stop there.
3. Longest-common-prefix intervals: suffixes whose common prefix holds
   ``min_words`` words share the shortest prefix with so many words; its m
   lines are named by two overlapping ranks of 2**j <= m lines.  The same is
   done for the shortest window that ends at a line.  Every line of a repeated
   run with enough words lies in such a window inside the run, so deleting all
   windows but the first of each interval deletes the later copies of the
   maximal runs, whole, and nothing else.

DataFrame operations only.  Memory per task: one document's lines, as they
come from one text value.

Defined cases: null text is empty and stays null; blank lines are never
deleted and don't interrupt a run; rows repeated with one doc_id and text are
one document (all get the same result); a null doc_id counts as the
smallest number; an empty
table gives no rows; extra columns are carried along, and those named like an
added column (``n_lines``, ``deleted``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.shared import NOT_SPACE, materialise

MIN_WORDS = 50
KEYS = ["d", "t1", "t2"]
#: a line end with the blank lines after it
LINE_END = r"\n(?:[ \t\x0B\f\r]*\n)*"


def _keys() -> list[Column]:
    """Document key: doc_id (null: the smallest number) and 128 bits of the
    text, which tell documents of one id apart."""
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("t1"),
            F.xxhash64(F.lit(7), text).alias("t2")]


def document_lines(docs: DataFrame) -> DataFrame:
    """``d, t1, t2, seq, h1, h2, words``: the non-blank lines; ``seq``
    counts the pieces between line ends, blank lines in between skipped (a
    text that starts with a blank line has it as piece 0)."""
    x = docs.filter(F.col("text").isNotNull()).select(*_keys(), "text")
    x = x.select(*KEYS, F.posexplode(F.split("text", LINE_END)).alias("seq", "s"))
    return x.select(*KEYS, "seq", F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(7), "s").alias("h2"),
                    F.regexp_count("s", F.lit(NOT_SPACE)).alias("words")).filter("words > 0")


def ranked(distinct: DataFrame, by: list[str], name: str) -> DataFrame:
    """The place of each row in the order ``by``: a 64-bit number that
    grows along the range-sorted table (partition, then row)."""
    s = distinct.repartitionByRange(*by).sortWithinPartitions(*by)
    return s.withColumn(name, F.monotonically_increasing_id())


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Rows of all repeated lines with ``r0``, the rank by one line, ``run``
    (its uninterrupted sequence) and ``upto`` (words of the sequence up to
    and with the line)."""
    lines = materialise(document_lines(docs), "lines")
    again = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    ids = materialise(ranked(again, ["h1", "h2"], "r0"), "line_ids")
    x = (lines.join(ids, ["h1", "h2"]).groupBy(*KEYS, "seq")      # one row per place, also for repeated rows
         .agg(F.first("words").cast("long").alias("words"), F.first("r0").alias("r0")))
    in_doc = Window.partitionBy(*KEYS).orderBy("seq")
    x = x.withColumn("run", F.col("seq") - F.row_number().over(in_doc))
    in_run = Window.partitionBy(*KEYS, "run").orderBy("seq")
    return materialise(x.withColumn("upto", F.sum("words").over(in_run)), "repeated_lines")


def double(array: DataFrame, k: int) -> DataFrame:
    """One doubling: rank ``r{k}`` by 2**k lines to ``r{k+1}``; keeps the
    suffixes that are repeated at that length."""
    step = 1 << k
    ahead = Window.partitionBy(*KEYS, "run").orderBy("seq").rangeBetween(step, step)
    pairs = (array.select(*KEYS, "run", "seq", F.col(f"r{k}").alias("a"), F.first(f"r{k}").over(ahead).alias("b"))
             .filter("b IS NOT NULL"))
    pairs = materialise(pairs, f"pairs{k}")
    distinct = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    ranks = materialise(ranked(distinct, ["a", "b"], f"r{k + 1}"), f"ranks{k + 1}")
    return materialise(pairs.join(ranks, ["a", "b"]).drop("a", "b"), f"array{k + 1}")


def suffix_array(lines: DataFrame, max_lines: int) -> DataFrame:
    """``d, t1, t2, run, seq, k, r``: the rank ``r`` of every suffix of
    repeated lines by its first 2**k lines, as long as that is repeated, for
    2**k up to ``max_lines``; (r by 2**k, r by 2**k further on) sorts by any
    number of lines up to 2**(k+1)."""
    array, k = lines.select(*KEYS, "run", "seq", "r0"), 0
    rows = array.select(*KEYS, "run", "seq", F.lit(0).alias("k"), F.col("r0").alias("r"))
    while (2 << k) <= max_lines:
        array = double(array, k)
        if array.isEmpty():
            break
        k += 1
        rows = rows.unionByName(array.select(*KEYS, "run", "seq", F.lit(k).alias("k"), F.col(f"r{k}").alias("r")))
    return rows


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """``d, t1, t2, run, seq, m``: for each line the shortest run of lines
    from it, and the shortest up to it, that has ``min_words`` words."""
    in_run = Window.partitionBy(*KEYS, "run").orderBy("seq")
    after, before = in_run.rowsBetween(0, min_words - 1), in_run.rowsBetween(1 - min_words, 0)
    x = lines.select(*KEYS, "run", "seq", "upto", "words", F.collect_list("upto").over(after).alias("later"),
                     F.collect_list(F.col("upto") - F.col("words")).over(before).alias("sooner"))
    goal = F.col("upto") - F.col("words") + F.lit(min_words)
    ahead = F.size(F.filter("later", lambda u: u < goal)) + 1
    back = F.size(F.filter("sooner", lambda u: u > F.col("upto") - F.lit(min_words))) + 1
    both = F.array(F.when(ahead <= F.size("later"), F.struct(F.col("seq"), ahead.alias("m"))),
                   F.when(back <= F.size("sooner"), F.struct((F.col("seq") - back + 1).alias("seq"), back.alias("m"))))
    w = x.select(*KEYS, "run", F.explode(F.filter(F.array_distinct(both), lambda s: s.isNotNull())).alias("w"))
    return w.select(*KEYS, "run", "w.seq", "w.m").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, t1, t2, cut``: for each document with later copies the spans
    ``[start, end)`` of ``seq`` to delete."""
    lines = repeated_lines(docs)
    ranks = suffix_array(lines, min_words)
    # 2**k <= m < 2**(k+1): two ranks of 2**k lines, at the window's start and 2**k lines before its end
    w = windows(lines, min_words).withColumn("k", F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int"))
    place = F.struct("seq", "m")
    ends = w.select(*KEYS, "run", "k", place.alias("w"), F.explode(F.array_distinct(F.array(
        F.col("seq"), F.col("seq") + F.col("m") - F.expr("shiftleft(1, k)").cast("int")))).alias("seq"))
    names = (ends.join(ranks, [*KEYS, "run", "seq", "k"]).groupBy(*KEYS, "run", "w")
             .agg(F.min_by("r", "seq").alias("a"), F.max_by("r", "seq").alias("b"), F.count(F.lit(1)).alias("n")))
    whole = F.col("n") == F.when(F.col("w.m") == F.expr("shiftleft(1, cast(floor(log2(w.m + 0.5)) as int))"), 1).otherwise(2)
    names = materialise(names.filter(whole).select(*KEYS, "run", "w.seq", "w.m", "a", "b"), "intervals")
    start = F.struct(*KEYS, "seq")
    first = names.groupBy("m", "a", "b").agg(F.min(start).alias("first"), F.max(start).alias("last")).filter("first < last").drop("last")
    first = materialise(first, "firsts")       # a table of its own: AQE can split a frequent interval's rows in the join
    # windows of a document overlap: those that touch become one span
    ends = (names.join(first, ["m", "a", "b"]).filter(start != F.col("first"))
            .groupBy(*KEYS, "seq").agg(F.max(F.col("seq") + F.col("m")).alias("end")))
    in_doc = Window.partitionBy(*KEYS).orderBy("seq")
    before = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    block = F.sum(F.when(F.col("seq") <= F.col("before"), 0).otherwise(1)).over(in_doc)
    spans = ends.withColumn("before", before).withColumn("block", block)
    return (spans.groupBy(*KEYS, "block").agg(F.struct(F.min("seq").alias("start"), F.max("end").alias("end")).alias("span"))
            .groupBy(*KEYS).agg(F.sort_array(F.collect_list("span")).alias("cut")))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, n_lines: str = "n_lines", deleted: str = "deleted") -> DataFrame:
    """``docs`` with later copies deleted from ``text``, and two columns (of
    these names; replaced, if there): the lines of a document, and the places
    of the deleted ones, ascending."""
    docs = docs.drop(n_lines, deleted)
    own = docs.select(F.struct(*docs.columns).alias("row"), *_keys())
    j = own.join(later_copies(docs, min_words), KEYS, "left")
    lines = F.split("row.text", "\n")
    filled = F.filter(F.transform(lines, lambda s, i: F.when(s.rlike(NOT_SPACE), i)), lambda i: i.isNotNull())
    first = F.when(F.get(lines, F.lit(0)).rlike(NOT_SPACE), 0).otherwise(1)
    j = j.withColumn("filled", F.when(F.col("cut").isNotNull(), F.struct(filled.alias("at"), first.alias("first"))))
    gone = F.flatten(F.transform("cut", lambda c: F.slice("filled.at", c["start"] - F.col("filled.first") + 1, c["end"] - c["start"])))
    j = j.withColumn("gone", F.when(F.col("cut").isNotNull(), gone))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.array_join(F.transform("kept", lambda i: F.get("pieces", i)), "\n")
    j = j.withColumns({"kept": F.when(F.col("cut").isNotNull(), left), "pieces": F.when(F.col("cut").isNotNull(), lines)})
    return j.select(*[(F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(text) if c == "text" else F.col("row")[c]).alias(c)
                      for c in docs.columns],
                    F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).alias(n_lines),
                    F.coalesce("gone", F.array().cast("array<int>")).alias(deleted))


def line_dedup_sql(min_words: int = MIN_WORDS) -> str:
    """Deleted lines in DuckDB SQL by comparing the windows' texts."""
    return f"""
WITH s AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
w AS (SELECT *, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) AS words FROM s),
b AS (SELECT *, row_number() OVER d - 1 AS seq, sum(words) OVER d AS upto FROM w WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY line)),
a AS (SELECT doc_id, list(s ORDER BY seq) AS a FROM b GROUP BY doc_id),
x AS (SELECT p.doc_id, p.seq AS i, min(e.seq) AS j FROM b p JOIN b e ON p.doc_id = e.doc_id AND e.upto >= p.upto - p.words + {min_words} GROUP BY ALL
      UNION SELECT e.doc_id, max(p.seq) AS i, e.seq AS j FROM b p JOIN b e ON p.doc_id = e.doc_id AND p.upto - p.words <= e.upto - {min_words} GROUP BY e.doc_id, e.seq),
v AS (SELECT x.*, list_aggregate(a.a[i + 1:j + 1], 'string_agg', chr(10)) AS content FROM x JOIN a USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS pos FROM v),
c AS (SELECT DISTINCT b.doc_id, b.line FROM r JOIN b ON r.doc_id = b.doc_id AND b.seq BETWEEN r.i AND r.j WHERE r.pos > 1),
k AS (SELECT doc_id, string_agg(line::VARCHAR, ',' ORDER BY line) AS deleted FROM c GROUP BY doc_id),
t AS (SELECT s.doc_id, coalesce(string_agg(s.s, chr(10) ORDER BY s.line) FILTER (WHERE c.line IS NULL), '') AS text
      FROM s LEFT JOIN c ON s.doc_id = c.doc_id AND s.line = c.line GROUP BY s.doc_id)
SELECT d.doc_id, t.text, coalesce(len(string_split(d.text, chr(10))), 0)::INT AS n_lines, coalesce(k.deleted, '') AS deleted
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN k USING (doc_id)"""
