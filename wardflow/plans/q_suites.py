"""Predicate, join, schema-unification, set and scalar-rule suites, and the
stay-level derived tables (diagnosis, death reconciliation, horizons)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.scalar import (any_not_null, bmi, digits_only, fio2_reconciled, first_char, r6,
                                       whole_days_between)
from wardflow.operators import relational as R
from wardflow.plans import common as C
from wardflow.plans.registry import query
from wardflow.plans.sql_common import daily_panel_ctes
from wardflow.sources.tables import ENTITY, read_table

# --- fixed values: status code relabelling ------------------------------------
STATUS_LABELS = [("F", "finished"), ("O", "open"), ("P", "partial")]


@query("filters_suite", sql=f"""
WITH {C.STAYS_CTE}
SELECT o_orderkey,
  o_totalprice BETWEEN 100000 AND 200000 AS closed_range,
  (o_totalprice > 100000 AND o_totalprice <= 200000) AS half_open,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS in_list,
  (o_orderstatus = 'F' AND o_totalprice > 150000) AS conjunctive,
  out_time IS NULL AS is_open,
  (out_time IS NOT NULL OR o_orderstatus = 'P') AS any_value,
  CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 250000 THEN 'mid' ELSE 'high' END AS price_band,
  nullif(o_orderkey % 5, 0) AS zero_to_null,
  CAST(o_totalprice > 300000 AS INTEGER) AS above_threshold,
  o_orderstatus = 'O' AS is_status_o,
  (in_time < TIMESTAMP '1998-01-01 00:00:00' AND year(in_time) > 1995) AS date_window,
  CASE WHEN o_orderstatus = 'F' THEN 'DECES' ELSE 'SURVIE' END AS outcome_label,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_label,
  coalesce(CAST(date_sub('day', in_time, out_time) AS BIGINT), -1) AS los_or_default
FROM stays""")
def filters_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6-B11/B13/B15/B16/B18/B19/B22/B25/B26 and parts of B12/B14
    (``drop_empty_rows``): one flag column per predicate family
    (closed / half-open range, IN list, conjunction, null tests, any-of,
    CASE chain, zero-to-null, threshold flag, equality encode, date cut-offs,
    label from text, relabel map, placeholder default)."""
    s = C.stays(spark, sf_dir)
    relabel = F.create_map(*[x for k, v in STATUS_LABELS for x in (F.lit(k), F.lit(v))])
    out = s.select(
        "o_orderkey",
        F.col("o_totalprice").between(100000, 200000).alias("closed_range"),
        ((F.col("o_totalprice") > 100000) & (F.col("o_totalprice") <= 200000)).alias("half_open"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("in_list"),
        ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 150000)).alias("conjunctive"),
        F.col("out_time").isNull().alias("is_open"),
        (any_not_null(["out_time"]) | (F.col("o_orderstatus") == "P")).alias("any_value"),
        F.when(F.col("o_totalprice") < 100000, "low").when(F.col("o_totalprice") < 250000, "mid")
         .otherwise("high").alias("price_band"),
        F.nullif(F.pmod("o_orderkey", F.lit(5)), F.lit(0)).alias("zero_to_null"),
        (F.col("o_totalprice") > 300000).cast("int").alias("above_threshold"),
        (F.col("o_orderstatus") == "O").alias("is_status_o"),
        ((F.col("in_time") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
         & (F.year("in_time") > 1995)).alias("date_window"),
        F.when(F.col("o_orderstatus") == "F", "DECES").otherwise("SURVIE").alias("outcome_label"),
        relabel[F.col("o_orderstatus")].alias("status_label"),
        whole_days_between("in_time", "out_time").cast("bigint").alias("los_or_default"))
    return out.na.fill({"los_or_default": -1})


@query("drop_null_rows", sql=f"""
WITH {daily_panel_ctes()}
SELECT user_id, day, heart_rate, fio2 FROM dp WHERE heart_rate IS NOT NULL AND fio2 IS NOT NULL""")
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop rows with a null in the given columns."""
    dp = C.daily_panel(spark, sf_dir)
    return dp.select(ENTITY, "day", "heart_rate", "fio2").na.drop(how="any", subset=["heart_rate", "fio2"])


@query("joins_suite", sql="""
SELECT 'inner' AS shape, count(*) AS n, CAST(sum(o.o_orderkey) AS BIGINT) AS key_sum
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT 'left', count(*), CAST(sum(coalesce(o.o_orderkey, 0)) AS BIGINT)
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
UNION ALL
SELECT 'lookup', count(*), CAST(sum(l.l_partkey) AS BIGINT)
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size IS NOT NULL AND l.l_quantity > 10
UNION ALL
SELECT 'multi_key_left', count(*), CAST(sum(coalesce(a.n, 0)) AS BIGINT)
  FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
                             WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber) a
    ON l.l_orderkey = a.l_orderkey AND l.l_linenumber = a.l_linenumber
UNION ALL
SELECT 'chained_inner', count(*), CAST(sum(r.r_regionkey) AS BIGINT)
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""")
def joins_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner, left, dimension lookup with filters, two-key
    left join, chained inner joins -- row count and key checksum each."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")

    def summ(df, shape, col):
        return df.agg(F.lit(shape).alias("shape"), F.count(F.lit(1)).alias("n"), F.sum(col).alias("key_sum"))

    inner = o.join(c, o["o_custkey"] == c["c_custkey"])
    left = c.join(o, o["o_custkey"] == c["c_custkey"], "left")
    lookup = (li.filter(F.col("l_quantity") > 10)
              .join(p.filter(F.col("p_size").isNotNull()), li["l_partkey"] == p["p_partkey"]))
    agg = (li.filter(F.col("l_returnflag") == "R").groupBy("l_orderkey", "l_linenumber")
           .agg(F.count(F.lit(1)).alias("cnt")))
    multi = li.join(agg, ["l_orderkey", "l_linenumber"], "left")
    chained = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
               .join(r, n["n_regionkey"] == r["r_regionkey"]))
    parts = [summ(inner, "inner", o["o_orderkey"]),
             summ(left, "left", F.coalesce(o["o_orderkey"], F.lit(0))),
             summ(lookup, "lookup", li["l_partkey"]),
             summ(multi, "multi_key_left", F.coalesce(F.col("cnt"), F.lit(0))),
             summ(chained, "chained_inner", r["r_regionkey"])]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn("key_sum", F.col("key_sum").cast("bigint"))


CANONICAL = {"entity_id": "bigint", "name": "string", "nation": "int", "balance": "double",
             "segment": "string", "name_digits": "int"}


@query("unify_sources", sql="""
SELECT entity_id, name, nation, balance, coalesce(segment, 'UNKNOWN') AS segment,
       TRY_CAST(regexp_replace(name, '[^0-9]', '', 'g') AS INTEGER) AS name_digits, source
FROM (SELECT c_custkey AS entity_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
             c_mktsegment AS segment, 0 AS source FROM customer
      UNION ALL
      SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 1 FROM supplier)""")
def unify_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources renamed to one canonical schema,
    missing columns added as typed nulls, non-strict cast, placeholder
    default, unioned by name."""
    c = read_table(spark, sf_dir, "customer").withColumn("name_digits", digits_only("c_name"))
    s = read_table(spark, sf_dir, "supplier").withColumn("name_digits", digits_only("s_name"))
    cols = dict(CANONICAL)
    c_ren = {"c_custkey": "entity_id", "c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance",
             "c_mktsegment": "segment"}
    s_ren = {"s_suppkey": "entity_id", "s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"}
    # non-strict cast of the digits (bad value -> null): try_cast before unify
    c = c.withColumn("name_digits", F.col("name_digits").try_cast("int"))
    s = s.withColumn("name_digits", F.col("name_digits").try_cast("int"))
    missing_in_supplier = sorted(set(cols) - set(s_ren.values()) - {"name_digits"})  # G4
    u = R.unify([(c, c_ren), (s, s_ren)], cols)
    return u.na.fill({m: "UNKNOWN" for m in missing_in_supplier})


@query("dedupe_rows", sql="""
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem""")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate rows removed."""
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                        "l_linestatus").distinct()


@query("dedupe_first", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the first row per key in an explicit total order."""
    li = read_table(spark, sf_dir, "lineitem")
    order = [("l_shipdate", False), ("l_extendedprice", False), ("l_partkey", False), ("l_suppkey", False),
             ("l_quantity", False)]
    return R.first_per_key(li, ["l_orderkey", "l_linenumber"], order, ["l_quantity", "l_extendedprice"])


@query("unpivot_long", sql="""
SELECT n_name, 'n_nationkey' AS variable, CAST(n_nationkey AS BIGINT) AS value FROM nation
UNION ALL SELECT n_name, 'n_regionkey', CAST(n_regionkey AS BIGINT) FROM nation""")
def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide -> long (melt); a transpose is unpivot + pivot."""
    n = read_table(spark, sf_dir, "nation").select(
        "n_name", F.col("n_nationkey").cast("bigint"), F.col("n_regionkey").cast("bigint"))
    return n.unpivot(["n_name"], ["n_nationkey", "n_regionkey"], "variable", "value")


@query("transpose_small", sql="""
SELECT variable, max(CASE WHEN l_returnflag = 'A' THEN v END) AS A, max(CASE WHEN l_returnflag = 'N' THEN v END) AS N,
       max(CASE WHEN l_returnflag = 'R' THEN v END) AS R
FROM (SELECT l_returnflag, 'n' AS variable, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY l_returnflag
      UNION ALL SELECT l_returnflag, 'qty', round(avg(l_quantity), 6) FROM lineitem GROUP BY l_returnflag)
GROUP BY variable""")
def transpose_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small result table transposed (unpivot, then pivot with an
    explicit value list)."""
    li = read_table(spark, sf_dir, "lineitem")
    t = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                       r6(F.avg("l_quantity")).alias("qty"))
    long = t.unpivot(["l_returnflag"], ["n", "qty"], "variable", "v")
    return long.groupBy("variable").pivot("l_returnflag", ["A", "N", "R"]).agg(F.max("v"))


@query("scalar_rules", sql=f"""
WITH {daily_panel_ctes()}
SELECT user_id, day,
  round(heart_rate, 1) AS hr_1dp,
  CASE WHEN pam_invasive / (((heart_rate + 100) / 100) * ((heart_rate + 100) / 100)) BETWEEN 5 AND 100
       THEN round(pam_invasive / (((heart_rate + 100) / 100) * ((heart_rate + 100) / 100)), 6) END AS bmi,
  round(day * 24 / 24.0, 6) AS days,
  round(CASE WHEN fio2 IS NOT NULL THEN fio2 WHEN pam_non_invasive IS NULL THEN 21.0
             WHEN pam_invasive / 20 BETWEEN 0 AND 15 THEN 4.0 * (pam_invasive / 20) + 21.0 END, 6) AS fio2_corr,
  CASE WHEN day = 0 THEN coalesce(pam_invasive, pam_non_invasive) ELSE pam_invasive END AS weight_filled,
  CASE WHEN heart_rate > 100 AND fio2 > 50 THEN 'both' WHEN heart_rate > 100 THEN 'first'
       WHEN fio2 > 50 THEN 'second' ELSE 'none' END AS renal_label,
  round(CASE WHEN pam_invasive - fio2 <> 0 THEN heart_rate / (pam_invasive - fio2) END, 6) AS compliance,
  CAST(heart_rate > 50 AS VARCHAR) AS hr_high_text,
  CAST((heart_rate IS NOT NULL OR fio2 IS NOT NULL OR pam_invasive IS NOT NULL) AS VARCHAR) AS device_present
FROM dp""")
def scalar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding, BMI with plausibility range, unit change,
    oxygen-fraction reconciliation, bin-0 back-fill, two-flow label,
    guarded ratio, boolean to text, device-presence text flag."""
    dp = C.daily_panel(spark, sf_dir)
    b = bmi("pam_invasive", F.col("heart_rate") + 100)
    return dp.select(
        ENTITY, "day", F.round("heart_rate", 1).alias("hr_1dp"),
        F.when(b.between(5, 100), r6(b)).alias("bmi"),
        r6(F.col("day") * 24 / 24.0).alias("days"),
        r6(fio2_reconciled("fio2", F.when(F.col("pam_non_invasive").isNull(), F.lit("air")),
                           F.col("pam_invasive") / 20)).alias("fio2_corr"),
        F.when(F.col("day") == 0, F.coalesce("pam_invasive", "pam_non_invasive"))
         .otherwise(F.col("pam_invasive")).alias("weight_filled"),
        F.when((F.col("heart_rate") > 100) & (F.col("fio2") > 50), "both")
         .when(F.col("heart_rate") > 100, "first").when(F.col("fio2") > 50, "second")
         .otherwise("none").alias("renal_label"),
        r6(F.try_divide(F.col("heart_rate"), F.nullif(F.col("pam_invasive") - F.col("fio2"), F.lit(0.0))))
        .alias("compliance"),
        (F.col("heart_rate") > 50).cast("string").alias("hr_high_text"),
        any_not_null(["heart_rate", "fio2", "pam_invasive"]).cast("string").alias("device_present"))


@query("text_flags", sql="""
SELECT event_id, user_id,
  CASE WHEN contains(props, '"k": 6') THEN 'prone' END AS prone_flag,
  CASE WHEN contains(props, '"k": 1') OR contains(props, '"k": 2') THEN CAST(1.0 AS DOUBLE) END AS product_flag,
  CASE WHEN isnan(value) THEN NULL ELSE value END AS value_clean
FROM events WHERE contains(props, '"k": 6') OR contains(props, '"k": 1') OR contains(props, '"k": 2')""")
def text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal substring flags (label else null, then rows
    without a flag dropped), NaN -> null."""
    ev = read_table(spark, sf_dir, "events")
    prone = F.when(F.col("props").contains('"k": 6'), F.lit("prone"))
    prod = F.when(F.col("props").contains('"k": 1') | F.col("props").contains('"k": 2'), F.lit(1.0))
    out = ev.select("event_id", "user_id", prone.alias("prone_flag"), prod.alias("product_flag"),
                    F.nanvl(F.col("value"), F.lit(None).cast("double")).alias("value_clean"))
    return out.filter(F.col("prone_flag").isNotNull() | F.col("product_flag").isNotNull())


@query("horizon_flags", sql=f"""
WITH {C.STAYS_CTE},
d AS (SELECT o_orderkey, in_time, CASE WHEN o_orderstatus = 'F' THEN out_time END AS death_time FROM stays)
SELECT o_orderkey, date_sub('day', in_time, death_time) AS death_diff,
       coalesce(date_sub('day', in_time, death_time) < 5, FALSE) AS death_within_5d,
       coalesce(date_sub('day', in_time, death_time) < 3, FALSE) AS death_within_3d,
       coalesce(date_sub('hour', in_time, death_time) <= 24, FALSE) AS death_within_24h
FROM d""")
def horizon_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of H30 (``sequence_frame`` has the targets): death-horizon flags from a death time (closed 'F' stays); an
    unknown death time means not dead (explicit null handling)."""
    s = C.stays(spark, sf_dir)
    death = F.when(F.col("o_orderstatus") == "F", F.col("out_time"))
    dd = F.timestamp_diff("DAY", F.col("in_time"), death)
    dh = F.timestamp_diff("HOUR", F.col("in_time"), death)
    return s.select("o_orderkey", dd.alias("death_diff"),
                    F.coalesce(dd < 5, F.lit(False)).alias("death_within_5d"),
                    F.coalesce(dd < 3, F.lit(False)).alias("death_within_3d"),
                    F.coalesce(dh <= 24, F.lit(False)).alias("death_within_24h"))


@query("diagnosis_table", sql=f"""
WITH {C.STAYS_CTE},
lastst AS (SELECT o_custkey, o_orderstatus = 'F' AS died FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY in_time DESC, o_orderkey DESC) AS rn FROM stays)
  WHERE rn = 1),
firstst AS (SELECT o_custkey, o_orderpriority AS main_code, in_time, out_time FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY in_time, o_orderkey) AS rn FROM stays) WHERE rn = 1)
SELECT f.o_custkey, l.died, f.main_code, substr(f.main_code, 1, 1) AS category,
       date_sub('day', f.in_time, f.out_time) AS first_los_days
FROM firstst f JOIN lastst l ON f.o_custkey = l.o_custkey""")
def diagnosis_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T22/H11 and parts of T26 (``initial_unit_diagnosis``): died flag from the last discharge, main code and its
    category from the first stay, length of the first stay in days."""
    s = C.stays(spark, sf_dir)
    last = R.first_per_key(s, ["o_custkey"], [("in_time", True), ("o_orderkey", True)], ["o_orderstatus"])
    first = R.first_per_key(s, ["o_custkey"], [("in_time", False), ("o_orderkey", False)],
                            ["o_orderpriority", "in_time", "out_time"])
    j = first.join(last, "o_custkey")
    return j.select("o_custkey", (F.col("o_orderstatus") == "F").alias("died"),
                    F.col("o_orderpriority").alias("main_code"), first_char("o_orderpriority").alias("category"),
                    whole_days_between("in_time", "out_time").alias("first_los_days"))


@query("death_reconcile", sql=f"""
WITH {C.STAYS_CTE},
reg AS (SELECT l_orderkey, max(l_shipdate) AS reg_date, bool_or(l_returnflag = 'R') AS reg_died
        FROM lineitem GROUP BY l_orderkey),
j AS (SELECT s.o_orderkey, s.o_orderstatus = 'F' AS died_a, r.reg_died AS died_b, s.out_time, r.reg_date
      FROM stays s JOIN reg r ON s.o_orderkey = r.l_orderkey)
SELECT o_orderkey, died_a, died_b, died_a <> died_b AS mismatch,
       abs(date_sub('day', out_time, reg_date)) AS gap_days,
       CASE WHEN abs(date_sub('day', out_time, reg_date)) <= 1 THEN 'le_1d'
            WHEN abs(date_sub('day', out_time, reg_date)) > 1 THEN 'gt_1d' END AS gap_class
FROM j""")
def death_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two death sources compared -- XOR mismatch flag (null if
    either is null) and date gap split at 1 day."""
    s = C.stays(spark, sf_dir)
    reg = (read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
           .agg(F.max("l_shipdate").alias("reg_date"), F.bool_or(F.col("l_returnflag") == "R").alias("reg_died")))
    j = s.join(reg, "o_orderkey")
    gap = F.abs(whole_days_between("out_time", "reg_date"))
    return j.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("died_a"),
                    F.col("reg_died").alias("died_b"),
                    ((F.col("o_orderstatus") == "F") != F.col("reg_died")).alias("mismatch"),
                    gap.alias("gap_days"),
                    F.when(gap <= 1, "le_1d").when(gap > 1, "gt_1d").alias("gap_class"))
