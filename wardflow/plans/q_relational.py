"""Stay/as-of, joins, filters, grouping and scalar-rule queries over the
TPC-H-like tables (orders = stays, lineitem = charted rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.dictionary import literal_table
from wardflow.functions.scalar import (digits_only, first_char, first_token, hours_between,
                                       parse_percent, r6, safe_double, whole_days_between)
from wardflow.operators import asof as A
from wardflow.operators import privacy as PV
from wardflow.operators import relational as R
from wardflow.operators.stats import attach_row
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.sources.tables import read_table

EFF_CTE = f"""{C.STAYS_CTE},
mx AS (SELECT o_custkey, max(coalesce(out_time, TIMESTAMP '{A.FAR_FUTURE}')) AS mo FROM stays GROUP BY o_custkey),
s AS (SELECT st.*, CASE WHEN st.out_time IS NULL OR st.out_time = mx.mo THEN TIMESTAMP '{A.FAR_FUTURE}'
                        ELSE st.out_time END AS eff_out
      FROM stays st JOIN mx ON st.o_custkey = mx.o_custkey)"""


def _eff_stays(spark, sf_dir) -> DataFrame:
    return A.effective_end(C.stays(spark, sf_dir), "o_custkey", "out_time")


@query("open_stay_end", sql=f"""
WITH {EFF_CTE}
SELECT o_custkey, o_orderkey, in_time, out_time, eff_out FROM s""")
def open_stay_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective stay end -- open or latest stay of an entity ends
    at 2050-12-31 (entity maximum as an aggregate, not a self join)."""
    return _eff_stays(spark, sf_dir).select("o_custkey", "o_orderkey", "in_time", "out_time", "eff_out")


def _charted(spark, sf_dir, where=None) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate",
                                                      "l_returnflag")
    if where is not None:
        li = li.filter(where)
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey")


def _asof_sql(order: str, where: str = "TRUE") -> str:
    return f"""WITH {EFF_CTE},
ev AS (SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE {where}),
k AS (SELECT DISTINCT o_custkey, l_shipdate FROM ev),
m AS (SELECT k.o_custkey, k.l_shipdate, s.o_orderkey,
             row_number() OVER (PARTITION BY k.o_custkey, k.l_shipdate ORDER BY {order}) AS rn
      FROM k JOIN s ON s.o_custkey = k.o_custkey AND s.eff_out >= k.l_shipdate)
SELECT ev.l_orderkey, ev.l_linenumber, ev.l_shipdate, ev.o_custkey, m.o_orderkey AS stay_orderkey
FROM ev LEFT JOIN m ON m.o_custkey = ev.o_custkey AND m.l_shipdate = ev.l_shipdate AND m.rn = 1"""


@query("asof_next_stay", sql=_asof_sql("s.in_time, s.o_orderkey"))
def asof_next_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every charted row attached to the first stay (by in-time, id)
    of its entity that ends at or after the chart time."""
    st = _eff_stays(spark, sf_dir)
    out = A.asof_first_ending_after(_charted(spark, sf_dir), st, "o_custkey", "l_shipdate",
                                    ["in_time", "o_orderkey"], "eff_out", ["o_orderkey"])
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey",
                      F.col("stay")["o_orderkey"].alias("stay_orderkey"))


@query("asof_two_key", sql=_asof_sql("s.o_orderpriority, s.in_time, s.o_orderkey", "l.l_returnflag = 'R'"))
def asof_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: as C10 on a filtered event set with another stay order
    (priority code, then in-time, then id)."""
    st = _eff_stays(spark, sf_dir)
    ev = _charted(spark, sf_dir, F.col("l_returnflag") == "R")
    out = A.asof_first_ending_after(ev, st, "o_custkey", "l_shipdate",
                                    ["o_orderpriority", "in_time", "o_orderkey"], "eff_out", ["o_orderkey"])
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey",
                      F.col("stay")["o_orderkey"].alias("stay_orderkey"))


@query("dictionary_semijoin", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE '%gear%')
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)""")
def dictionary_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two independent IN (sub-select) predicates as left-semi joins
    (a pair outside the dictionary still passes, as in the source query)."""
    li = read_table(spark, sf_dir, "lineitem")
    parts = read_table(spark, sf_dir, "part").filter(F.col("p_name").contains("gear")).select(
        F.col("p_partkey").alias("l_partkey"))
    sups = read_table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") < 10).select(
        F.col("s_suppkey").alias("l_suppkey"))
    return (li.join(parts, "l_partkey", "left_semi").join(sups, "l_suppkey", "left_semi")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))


_FEATS_SQL = "(VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) f(event_type)"


@query("missing_entities", sql=f"""
WITH cohort AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'),
g AS (SELECT c.user_id, f.event_type FROM cohort c CROSS JOIN {_FEATS_SQL})
SELECT user_id, event_type FROM g
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = g.user_id AND e.event_type = g.event_type
                  AND e.value > 300)""")
def missing_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort entities without any high reading (value > 300) of a
    feature -- cohort x feature list (generator) anti-joined with the rows."""
    ev = read_table(spark, sf_dir, "events")
    cohort = ev.filter(F.col("event_type") == "signup").select("user_id").distinct()
    g = cohort.select("user_id", F.explode(F.array(*[F.lit(f) for f in
                                                     ["click", "error", "purchase", "signup", "view"]]))
                      .alias("event_type"))
    hits = ev.filter(F.col("value") > 300).select("user_id", "event_type")
    return g.join(hits, ["user_id", "event_type"], "left_anti")


@query("coverage_report", sql="""
WITH cohort AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'),
n AS (SELECT count(*) AS n_cohort FROM cohort)
SELECT e.event_type, count(DISTINCT e.user_id) AS n_entities, n.n_cohort,
       round(count(DISTINCT e.user_id) * 100.0 / n.n_cohort, 6) AS pct_covered
FROM events e JOIN cohort c ON e.user_id = c.user_id CROSS JOIN n
GROUP BY e.event_type, n.n_cohort""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cohort entities per feature over cohort size, one
    pass for all features."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type")
    cohort = ev.filter(F.col("event_type") == "signup").select("user_id").distinct()
    per = (ev.join(cohort, "user_id", "left_semi").groupBy("event_type")
           .agg(F.countDistinct("user_id").alias("n_entities")))
    n = cohort.agg(F.count(F.lit(1)).alias("n_cohort"))
    # one-row aggregate attached as a scalar subquery
    out = attach_row(per, n)
    return out.select("event_type", "n_entities", "n_cohort",
                      r6(F.col("n_entities") * 100.0 / F.col("n_cohort")).alias("pct_covered"))


@query("stay_rollup", sql=f"""
WITH {C.STAYS_CTE},
j AS (SELECT s.*, c.c_name, c.c_mktsegment, n.n_name FROM stays s
      JOIN customer c ON s.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT o_custkey, c_name, c_mktsegment, n_name, count(*) AS n_stays, min(in_time) AS first_in,
       max(out_time) AS last_out,
       round(date_sub('minute', min(in_time), max(out_time)) / 60.0, 2) AS los_hours,
       date_sub('day', min(in_time), max(out_time)) AS los_days,
       arg_min(o_totalprice, (in_time, o_orderkey)) AS first_price
FROM j GROUP BY o_custkey, c_name, c_mktsegment, n_name""")
def stay_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entity: first in, last out, length of stay in
    hours (2 dp) and whole days, first value in time order."""
    st = C.stays(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name",
                                                         "c_mktsegment", "c_nationkey")
    nat = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = st.join(cust, "o_custkey").join(nat, "c_nationkey")
    g = j.groupBy("o_custkey", "c_name", "c_mktsegment", "n_name").agg(
        F.count(F.lit(1)).alias("n_stays"), F.min("in_time").alias("first_in"),
        F.max("out_time").alias("last_out"),
        F.min_by("o_totalprice", F.struct("in_time", "o_orderkey")).alias("first_price"))
    return g.select("o_custkey", "c_name", "c_mktsegment", "n_name", "n_stays", "first_in", "last_out",
                    F.round(hours_between("first_in", "last_out"), 2).alias("los_hours"),
                    whole_days_between("first_in", "last_out").alias("los_days"), "first_price")


@query("latest_per_key", sql="""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC NULLS FIRST, o_totalprice ASC NULLS FIRST,
                                        o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per key under a mixed-direction total order
    (date desc, price asc, id desc; nulls first both ways)."""
    o = read_table(spark, sf_dir, "orders")
    return R.first_per_key(o, ["o_custkey"],
                           [("o_orderdate", True), ("o_totalprice", False), ("o_orderkey", True)],
                           ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("best_match", sql="""
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate,
       (o_orderpriority <> '5-LOW') AS flagged FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderdate ASC,
                                                          o_orderkey ASC) AS rn
  FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1""")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Among accepted candidates, the best score then earliest date per
    id, with a derived flag."""
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    b = R.first_per_key(o, ["o_custkey"], [("o_totalprice", True), ("o_orderdate", False),
                                           ("o_orderkey", False)],
                        ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return b.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
                    (F.col("o_orderpriority") != "5-LOW").alias("flagged"))


TEXT_PATTERN = "Ouré|Thnt|Anat"
TEXT_PATTERN_WIDE = "Ouré|Thnt|Anat|src1"


@query("cohort_text_regex", sql=f"""
SELECT doc_id, lang, n_chars FROM documents
WHERE coalesce(regexp_matches(text, '{TEXT_PATTERN}'), FALSE)
   OR coalesce(regexp_matches(source, '{TEXT_PATTERN_WIDE}'), FALSE)""")
def cohort_text_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regex selection over two free-text columns (null = no match),
    over the whole text."""
    d = read_table(spark, sf_dir, "documents")
    hit = (F.coalesce(F.col("text").rlike(TEXT_PATTERN), F.lit(False))
           | F.coalesce(F.col("source").rlike(TEXT_PATTERN_WIDE), F.lit(False)))
    return d.filter(hit).select("doc_id", "lang", "n_chars")


# --- fixed values: synonym lists -> category (first matching list wins) ----
SYNONYMS = [
    ("LARGE", "size", 1),
    ("SMALL", "size", 2),
    ("MEDIUM", "size", 3),
    ("ECONOMY", "price", 4),
    ("PROMO", "price", 5),
    ("PROMO", "campaign", 6),
    ("STANDARD", "grade", 7),
]
# --- fixed values: coded priority -> label -------------------------------------
PRIORITY_LABELS = [("1", "urgent"), ("2", "high"), ("3", "medium"), ("4", "unspecified"), ("5", "low")]


def _syn_sql() -> str:
    vals = ", ".join(f"('{a}', '{b}', {p})" for a, b, p in SYNONYMS)
    return f"(VALUES {vals}) syn(raw, category, priority)"


@query("recode_synonyms", sql=f"""
WITH syn AS (SELECT * FROM {_syn_sql()}),
best AS (SELECT raw, arg_min(category, priority) AS category FROM syn GROUP BY raw),
p AS (SELECT p_partkey, p_type AS material FROM part)
SELECT p.p_partkey, p.material, b.category FROM p LEFT JOIN best b ON p.material = b.raw""")
def recode_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9: raw value -> category through a broadcast mapping table with a
    priority (first matching list wins); unknown -> null."""
    syn = literal_table(spark, SYNONYMS, "raw string, category string, priority int")
    best = syn.groupBy("raw").agg(F.min_by("category", "priority").alias("category"))
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("material"))
    return p.join(F.broadcast(best), p["material"] == best["raw"], "left").select(
        "p_partkey", "material", "category")


@query("percent_parse", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE 'Predicted mortality : ' || CAST(l_linenumber AS VARCHAR)
       || ',' || CAST(l_partkey % 10 AS VARCHAR) || '%' END AS txt,
  CASE WHEN l_returnflag = 'A' THEN 'x' || CAST(l_quantity AS VARCHAR) ELSE CAST(l_quantity AS VARCHAR) END AS qty_txt
  FROM lineitem)
SELECT l_orderkey, l_linenumber, txt,
  round(TRY_CAST(replace(regexp_extract(txt, '(-?[0-9]+(?:[.,][0-9]+)?)\\s*%', 1), ',', '.') AS DOUBLE) / 100.0, 6) AS pct,
  TRY_CAST(qty_txt AS DOUBLE) AS qty
FROM t""")
def percent_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2/H3: percent text '... : 3,7%' -> 0.037 (else null); safe numeric
    parse of text (bad value -> null, no error)."""
    li = read_table(spark, sf_dir, "lineitem")
    txt = F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(F.concat(
        F.lit("Predicted mortality : "), F.col("l_linenumber").cast("string"), F.lit(","),
        F.pmod("l_partkey", F.lit(10)).cast("string"), F.lit("%")))
    qty_txt = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("x"), F.col("l_quantity").cast("string"))
                     ).otherwise(F.col("l_quantity").cast("string"))
    t = li.select("l_orderkey", "l_linenumber", txt.alias("txt"), qty_txt.alias("qty_txt"))
    return t.select("l_orderkey", "l_linenumber", "txt", r6(parse_percent("txt")).alias("pct"),
                    safe_double("qty_txt").alias("qty"))


@query("id_digits", sql="""
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
       TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS id_num,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium'
            WHEN '4' THEN 'unspecified' WHEN '5' THEN 'low' END AS priority_label,
       substr(o.o_orderpriority, 1, 1) AS priority_code
FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey""")
def id_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier stripped to digits; coded value -> label
    (map lookup); first character of a code."""
    c = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("o_orderpriority"))
    lab = F.create_map(*[x for k, v in PRIORITY_LABELS for x in (F.lit(k), F.lit(v))])
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left")
    code = first_char("o_orderpriority")
    return j.select("c_custkey", digits_only("c_name").alias("digits"),
                    digits_only("c_name").try_cast("bigint").alias("id_num"),
                    lab[code].alias("priority_label"), code.alias("priority_code"))


@query("pseudonymise", sql="""
SELECT TRUE AS pseudo_ok, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H24/B2, part of T20: identifying columns dropped, keyed pseudonym (told
    here only as well formed, as it depends on the session's key)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    out = PV.pseudonymise(c, "c_custkey", ["c_name"], PV.pseudonym_key(spark))
    return out.select(PV.well_formed("pseudo_id").alias("pseudo_ok"), "c_nationkey", "c_acctbal", "c_mktsegment")


@query("first_token", sql="""
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS code, CAST(year(o_orderdate) AS INTEGER) AS yr,
       CAST(month(o_orderdate) AS INTEGER) AS mo
FROM orders""")
def first_token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8/H7: first element of a split text; year/month extraction."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", first_token("o_orderpriority", "-").alias("code"),
                    F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo"))
