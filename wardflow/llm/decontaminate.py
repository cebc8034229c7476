"""Benchmark decontamination by spaced seeds.

A spaced seed is a fixed mask over consecutive words: the marked words are
hashed, the others ignored, so a substituted word breaks only the windows
that have it at a marked place.  The seeds of all benchmark items and of all
training windows are joined (a training window is hashed only where it has
the window's anchor, its rarest marked word); a hit puts the item at one
place (diagonal) of the document.  There the item is compared with the words
of the document, and an overlap counts by any of three rules:

* whole: at least ``min_share`` of the item's words agree on the diagonal,
  substitutions in between or cut ends included;
* stretch: ``MIN_STRETCH`` words (all of a shorter item) agree in one stretch,
  in which most words agree: a quotation of part of the item;
* chain: the stretches on neighbouring diagonals (inserted or deleted words
  shift a copy by at most ``MAX_SHIFT`` from one hit to the next) together
  hold ``min_share`` of the item's words, each counted once.

Items too short for a mask have one seed, all their words; items that two
shifts can cut into pieces shorter than a mask have seeds of ``SHORT_SEED``
running words besides.

DataFrame operations only.  Words are lower-cased runs of characters other
than white space.  Seeds, anchors and items of the benchmark are broadcast if
they have at most ``MAX_BROADCAST_SEEDS`` rows and ``MAX_BROADCAST_BYTES``
(counted), otherwise the joins are shuffled.

Defined cases: null text has no words; a null id is an id like others; an
item shorter than the shortest mask, even of one word, overlaps where all its
words stand in a row; rows repeated in either table give the same overlap
once; of several places of an item in a document the best one counts (the
whole rule before the others, then the most agreeing words), of equal ones
the first; very long texts are searched whole; empty tables give no overlaps;
extra columns, whatever their names, are ignored (``decontaminate`` keeps
them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.shared import SPACE, bounded_broadcast, materialise

#: fixed masks (1: compared, 0: ignored); the first bridges a substitution of every third word, the second of every fourth or fifth
MASKS = ("101101101", "101110011")
MIN_SHARE = 0.5
#: agreeing words of a stretch that counts by itself, and of one that counts in a chain
MIN_STRETCH, MIN_PIECE = 13, 4
#: a stretch ends where its agreeing words fall so far behind its best lead over the others
MAX_DROP = 8
MAX_SHIFT = 8
SHORT_SEED = 5
MAX_BROADCAST_SEEDS = 1_000_000
#: words in which windows begin that are searched together
PIECE = 64


def words(text: Column) -> Column:
    """Words in lower case (without the empty pieces that white space at
    either end leaves)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")


def _marked(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _seed(words: str, at: Column) -> Column:
    """Hash of the mask's number and the marked words (``offsets``) of the
    window at ``at``."""
    return F.xxhash64("mask_no", F.transform("offsets", lambda o: F.get(words, at + o)))


def _all_masks(masks: tuple[str, ...]) -> tuple[str, ...]:
    """``masks`` and runs of 1, 2, ... words up to the shortest mask."""
    return (*masks, *["1" * n for n in range(1, max(min(map(len, masks)), SHORT_SEED + 1))])


def _has_mask(n: int, masks: tuple[str, ...]) -> Column:
    """Whether an item (``words``) has seeds of mask ``n`` of ``_all_masks``."""
    shortest, size = min(map(len, masks)), F.size("words")
    run = n - len(masks) + 1
    if n < len(masks):
        return size >= len(masks[n])
    whole = (size == run) if run < shortest else F.lit(False)
    return whole | ((size >= shortest) & (size < 3 * shortest)) if run == SHORT_SEED else whole


def word_counts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(word, n)``: how often the benchmark's words stand in all documents.
    Only the choice of anchors rests on it, and any choice gives the same
    overlaps."""
    known = materialise(items.select(F.explode(words(F.col("text"))).alias("word")).distinct(), "words")
    seen = docs.select(F.explode(words(F.col("text"))).alias("word"))
    return seen.join(bounded_broadcast(known, MAX_BROADCAST_SEEDS), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def benchmark_seeds(items: DataFrame, masks: tuple[str, ...], counts: DataFrame) -> DataFrame:
    """``item, item_t, mask_no, item_at, seed, anchor, next_word, place,
    next_place, offsets, span``: all windows of the items; ``mask_no`` counts
    ``_all_masks``.  The anchor is the window's marked word that ``counts`` has
    least often (the longest, the first of equal ones), at ``place`` in the
    window, the next word the one after it: a training window can only match
    where both stand, which spares all other windows."""
    w = items.select("item", "item_t", words(F.col("text")).alias("words")).distinct()
    often = (w.select("item", "item_t", F.posexplode("words").alias("pos", "word")).join(counts, "word", "left")
             .groupBy("item", "item_t").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n")))).alias("often")))
    often = often.select(F.col("item").alias("i"), F.col("item_t").alias("it"), F.col("often.n").alias("often"))
    w = w.join(often, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_t") == F.col("it")))
    given, masks = masks, _all_masks(masks)
    kind = "array<struct<mask_no:int,item_at:int,offsets:array<int>,span:int>>"

    def windows(n: int, m: str) -> Column:
        at = F.transform(F.sequence(F.lit(0), F.size("words") - len(m)), lambda i: F.struct(
            F.lit(n).alias("mask_no"), i.alias("item_at"), F.array(*map(F.lit, _marked(m))).alias("offsets"), F.lit(len(m)).alias("span")))
        return F.when(_has_mask(n, given), at.cast(kind)).otherwise(F.array().cast(kind))

    rows = F.flatten(F.array(*[windows(n, m) for n, m in enumerate(masks)]))
    x = w.select("item", "item_t", "words", "often", F.explode(rows).alias("r")).select("item", "item_t", "words", "often", "r.*")
    rarest = F.array_sort(F.transform("offsets", lambda o: F.struct(
        F.get("often", F.col("item_at") + o).alias("n"), (-F.length(F.get("words", F.col("item_at") + o))).alias("l"), o.alias("place"))))
    x = x.withColumns({"place": F.get(rarest, F.lit(0))["place"], "next_place": F.coalesce(F.get(rarest, F.lit(1)), F.get(rarest, F.lit(0)))["place"]})
    word = lambda place: F.xxhash64(F.get("words", F.col("item_at") + F.col(place)))
    return x.select("item", "item_t", "mask_no", "item_at", _seed("words", F.col("item_at")).alias("seed"), word("place").alias("anchor"),
                    word("next_place").alias("next_word"), "place", "next_place", "offsets", "span").distinct()


def _keyed(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """``(name, name_t, text)``: the id and a hash that tells texts of one
    id apart."""
    text = F.coalesce("text", F.lit(""))
    return df.select(F.col(id_col).alias(name), F.xxhash64(text).alias(f"{name}_t"), text.alias("text"))


def _agree(w: Column, at: Column) -> Column:
    return F.coalesce(w == F.get("doc_words", at), F.lit(False))


def _stretches(diagonal: Column) -> Column:
    """Stretches ``(a, b, n)`` of the item's words from ``a`` to before ``b``,
    ``n`` of which agree: each begins at an agreeing word, agreeing words stay
    ahead of the others throughout, and it ends at its best lead."""
    cells = F.transform("item_words", lambda w, j: F.struct(j.alias("j"), _agree(w, diagonal + j).alias("same")))
    names = ("a", "b", "n", "count", "lead", "best")
    done = F.array().cast("array<struct<a:int,b:int,n:int>>")

    def state(values: tuple[Column, ...], done: Column) -> Column:
        return F.struct(*[v.cast("int").alias(k) for k, v in zip(names, values)], done.alias("done"))

    def closed(s: Column) -> Column:
        return F.when(s["n"] >= MIN_PIECE, F.concat(s["done"], F.array(F.struct(s["a"], s["b"], s["n"])))).otherwise(s["done"])

    def step(s: Column, c: Column) -> Column:
        old = [s[k] for k in names]
        one, none = F.lit(1), F.lit(0)
        first = state((c["j"], c["j"] + 1, one, one, one, one), s["done"])
        longer = state((s["a"], c["j"] + 1, s["count"] + 1, s["count"] + 1, s["lead"] + 1, s["lead"] + 1), s["done"])
        behind = state((s["a"], s["b"], s["n"], s["count"] + 1, s["lead"] + 1, s["best"]), s["done"])
        apart = state((s["a"], s["b"], s["n"], s["count"], s["lead"] - 1, s["best"]), s["done"])
        end = state((none,) * 6, closed(s))
        ends = (s["lead"] == 1) | (s["best"] - s["lead"] + 1 >= MAX_DROP)
        return (F.when(s["lead"] == 0, F.when(c["same"], first).otherwise(state(tuple(old), s["done"])))
                .when(c["same"], F.when(s["lead"] >= s["best"] - 1, longer).otherwise(behind))
                .when(ends, end).otherwise(apart))

    return F.aggregate(cells, state((F.lit(0),) * 6, done), step, closed)


def _pieces() -> Column:
    """``(j, at)``: item word and document word of all agreeing words in
    stretches on the diagonals around this one."""
    def on(shift: Column) -> Column:
        d = F.col("diagonal") + shift
        return F.flatten(F.transform(_stretches(d), lambda g: F.transform(
            F.filter(F.sequence(g["a"], g["b"] - 1), lambda j: _agree(F.get("item_words", j), d + j)),
            lambda j: F.struct(j.alias("j"), (d + j).alias("at")))))

    return F.flatten(F.transform(F.sequence(F.lit(-MAX_SHIFT), F.lit(MAX_SHIFT)), on))


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE,
             doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """``doc, doc_t, item, item_t, at, n_words, n_match, share``: per document
    and item the best overlap; ``at`` is its first word in the document,
    ``n_words`` its length there, ``share`` the agreeing part of the item (under
    ``min_share`` for a quotation of a smaller part)."""
    d, b = _keyed(docs, doc_id, "doc"), _keyed(benchmark, item_id, "item")
    test = materialise(benchmark_seeds(b, masks, word_counts(d, b)), "seeds")
    anchors = test.select("anchor", "next_word", "mask_no", "place", "next_place", "offsets", "span").distinct()
    at, longest = F.col("pos") - F.col("place"), max(map(len, _all_masks(masks)))
    # pieces of bounded length, so that what goes along with a word does not grow with its document
    pieces = F.transform(F.sequence(F.lit(0), F.size("words"), F.lit(PIECE)), lambda i: F.struct(
        i.alias("start"), F.slice("words", i + 1, F.lit(PIECE + longest - 1)).alias("words")))
    near = (d.select("doc", "doc_t", words(F.col("text")).alias("words"))
            .select("doc", "doc_t", F.explode(pieces).alias("piece")).select("doc", "doc_t", "piece.start", F.col("piece.words").alias("piece"))
            .select("doc", "doc_t", "start", "piece", F.posexplode("piece").alias("pos", "word"))
            .withColumn("anchor", F.xxhash64("word")).join(bounded_broadcast(anchors, MAX_BROADCAST_SEEDS), "anchor")
            .filter((at >= 0) & (at < PIECE) & (at + F.col("span") <= F.size("piece"))
                    & (F.xxhash64(F.get("piece", at + F.col("next_place"))) == F.col("next_word"))))
    windows = near.select("doc", "doc_t", (F.col("start") + at).alias("at"), "mask_no", _seed("piece", at).alias("seed"))
    hits = windows.join(bounded_broadcast(test.select("item", "item_t", "mask_no", "item_at", "seed"), MAX_BROADCAST_SEEDS), ["mask_no", "seed"])
    key = ["doc", "doc_t", "item", "item_t"]
    places = hits.select(*key, (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    along = Window.partitionBy(*key).orderBy("diagonal")
    near_last = F.col("diagonal") - F.lag("diagonal", 1).over(along) <= MAX_SHIFT
    places = places.withColumn("chain", F.when(near_last, None).otherwise(F.col("diagonal")))
    places = materialise(places.withColumn("chain", F.last("chain", True).over(along)), "places")
    items = b.select(F.col("item").alias("i"), F.col("item_t").alias("it"), words(F.col("text")).alias("item_words")).distinct()
    found = materialise(places.select(F.col("doc").alias("fd"), F.col("doc_t").alias("ft")).distinct(), "found")
    same = F.col("doc").eqNullSafe(F.col("fd")) & (F.col("doc_t") == F.col("ft"))
    texts = (d.join(bounded_broadcast(found, MAX_BROADCAST_SEEDS), same, "left_semi").distinct()
             .select(F.col("doc").alias("td"), F.col("doc_t").alias("tt"), words(F.col("text")).alias("doc_words")))
    x = (places.join(bounded_broadcast(items, MAX_BROADCAST_SEEDS), F.col("item").eqNullSafe(F.col("i")) & (F.col("item_t") == F.col("it")))
         .join(texts, F.col("doc").eqNullSafe(F.col("td")) & (F.col("doc_t") == F.col("tt"))))
    agree = F.filter(F.transform("item_words", lambda w, j: _agree(w, F.col("diagonal") + j)), lambda same: same)
    n_item, none = F.size("item_words"), F.array().cast("array<struct<j:int,at:int>>")
    x = x.withColumns({"n_item": n_item, "n_match": F.size(agree), "stretches": _stretches(F.col("diagonal"))})
    x = x.withColumn("long", F.array_max(F.transform("stretches", lambda g: F.struct(g["n"].alias("n"), (-g["a"]).alias("a"), g["b"].alias("b")))))

    def row(rank: int, n_match: Column, at: Column, end: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), n_match.alias("n_match"), (-at).alias("before"), (end - at).alias("n_words"), F.col("n_item"))

    start = F.greatest(F.col("diagonal"), F.lit(0))
    whole = F.when(F.col("n_match") >= F.col("n_item") * F.lit(min_share),
                   row(1, F.col("n_match"), start, F.least(F.col("diagonal") + n_item, F.size("doc_words"))))
    part = F.when(F.col("long.n") >= F.least(F.lit(MIN_STRETCH), F.col("n_item")),
                  row(0, F.col("long.n"), F.col("diagonal") - F.col("long.a"), F.col("diagonal") + F.col("long.b")))
    x = x.select(*key, "chain", "n_item", F.coalesce(whole, part).alias("o"),
                 F.when(whole.isNull() & part.isNull(), _pieces()).otherwise(none).alias("pieces"))
    x = x.groupBy(*key, "chain", "n_item").agg(F.max("o").alias("o"), F.flatten(F.collect_list("pieces")).alias("pieces"))
    x = x.withColumn("n_match", F.size(F.array_distinct("pieces.j")))
    chain = F.when((F.col("n_match") > 0) & (F.col("n_match") >= F.col("n_item") * F.lit(min_share)),
                   row(0, F.col("n_match"), F.array_min("pieces.at"), F.array_max("pieces.at") + 1))
    x = x.select(*key, F.coalesce("o", chain).alias("o")).filter("o IS NOT NULL").groupBy(*key).agg(F.max("o").alias("o"))
    return x.select(*key, (-F.col("o.before")).alias("at"), "o.n_words", "o.n_match", (F.col("o.n_match") / F.col("o.n_item")).alias("share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE,
                  doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item."""
    bad = materialise(overlaps(docs, benchmark, masks, min_share, doc_id, item_id).select("doc", "doc_t").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    same = F.col("id").eqNullSafe(F.col("doc")) & (F.col("t") == F.col("doc_t"))
    return rows.join(bounded_broadcast(bad, MAX_BROADCAST_SEEDS), same, "left_anti").select("row.*")


def overlaps_sql(masks: tuple[str, ...] = MASKS, min_share: float = MIN_SHARE) -> str:
    """The overlaps of the whole rule, found by ``masks``, in DuckDB SQL."""
    def side(table: str, key: str) -> str:
        span = max(map(len, masks))
        ahead = ", ".join(f"lead(w, {i}) OVER p AS w{i}" for i in range(span))
        return (f"SELECT *, {ahead} FROM (SELECT {key}, unnest(l) AS w, generate_subscripts(l, 1) - 1 AS pos FROM "
                f"(SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS l FROM {table})) "
                f"WINDOW p AS (PARTITION BY {key} ORDER BY pos)")

    def seed(src: str, key: str) -> str:
        parts = []
        for n, m in enumerate(masks):
            marked = " || ' ' || ".join(f"w{i}" for i, c in enumerate(m) if c == "1")
            parts.append(f"SELECT {key}, pos, '{n} ' || {marked} AS seed FROM {src} WHERE w{len(m) - 1} IS NOT NULL")
        return " UNION ALL ".join(parts)

    return f"""
WITH d AS ({side("documents", "doc_id")}), b AS ({side("benchmark", "item_id")}),
ds AS ({seed("d", "doc_id")}), bs AS ({seed("b", "item_id")}),
p AS (SELECT DISTINCT doc_id, item_id, ds.pos - bs.pos AS diagonal FROM ds JOIN bs USING (seed)),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id), m AS (SELECT doc_id, count(*) AS n_doc FROM d GROUP BY doc_id),
o AS (SELECT p.doc_id, p.item_id, p.diagonal, count(*) AS n_match FROM p JOIN b ON b.item_id = p.item_id
      JOIN d ON d.doc_id = p.doc_id AND d.pos = p.diagonal + b.pos AND d.w = b.w GROUP BY ALL),
r AS (SELECT *, greatest(diagonal, 0) AS start, least(diagonal + n_item, n_doc) - greatest(diagonal, 0) AS n_words,
        row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_match DESC, greatest(diagonal, 0), least(diagonal + n_item, n_doc) DESC) AS place
      FROM o JOIN n USING (item_id) JOIN m USING (doc_id) WHERE n_match >= n_item * {min_share})
SELECT doc_id, item_id, start::INT AS start, n_words::INT AS n_words, n_match::INT AS n_match, n_match / n_item AS share FROM r WHERE place = 1"""
