"""Whole chains over stays and panels: the static encounter table and what is
made of it (identity export, description, modelling tables, sequence inputs,
outcome frames), the one-week panel and the cleaned series.

Roles of the driver tables: a customer is a patient and its stays one
encounter; ``c_name`` carries the encounter id in text, ``o_orderpriority`` the
unit (five of them, four in the listed ones), ``c_acctbal / 100`` the age,
``c_nationkey`` the zone, returned line items of full quantity the death
registry, the first stay of an encounter its severity score, ``error`` events
the admission notes.  An ``events`` user is the customer of the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.dictionary import EVENT_FEATURES, literal_table
from wardflow.functions.scalar import all_null, bmi, digits_only, hours_between, minutes_between, parse_percent, r6, whole_days_between
from wardflow.operators import models as MD
from wardflow.operators import panel as P
from wardflow.operators import privacy as PV
from wardflow.operators import relational as R
from wardflow.operators import sequence as S
from wardflow.operators import stats as ST
from wardflow.operators.masking import digest, digest_sql
from wardflow.plans import common as C
from wardflow.plans import q_cohorts as QC
from wardflow.plans import q_models as QM
from wardflow.plans import q_panel as QP
from wardflow.plans.registry import ORACLES, query
from wardflow.plans.sql_common import cohort_ctes, fill_ctes, hourly_ctes, hourly_wide_cte
from wardflow.sources.tables import ENTITY, FEATURE, TEXT_VALUE, TIME, VALUE, measurements, read_table

D = C.DAILY_COLS
HF = C.HOURLY_FEATURES
UNITS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
ADULT = 18
FULL = 49
ADMISSION = {"1": "Unscheduled Surgery", "2": "Scheduled Surgery", "3": "Medical"}


# --------------------------------------------------------------------------
# static encounters
# --------------------------------------------------------------------------

def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays of adults in the listed units with the patient's data."""
    s = C.stays(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", F.floor(F.col("c_acctbal") / 100).alias("age"))
    c = c.filter(F.col("age") >= ADULT)
    j = s.filter(F.col("o_orderpriority").isin(UNITS)).join(c, s["o_custkey"] == c["c_custkey"])
    return j.select(digits_only("c_name").try_cast("bigint").alias("encounter"), F.col("c_custkey").alias("patient"), "age",
                    (F.col("c_nationkey") % 2).alias("gender"), F.col("c_nationkey").alias("zone"), (F.lit(150) + F.col("c_custkey") % 50).alias("height"),
                    (F.lit(40) + F.col("o_orderkey") % 80).alias("weight"), F.col("o_orderpriority").alias("unit"), "in_time", "out_time",
                    hours_between("in_time", "out_time").alias("hours"), F.col("o_orderkey").alias("stay"))


def death_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One confirmed registry row per patient: the best score, then the
    earliest date."""
    li = read_table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= FULL))
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient"))
    best = R.first_per_key(li.join(o, "l_orderkey"), ["patient"], [("l_quantity", True), ("l_shipdate", False), ("l_orderkey", False),
                                                                  ("l_linenumber", False), ("l_partkey", False)], ["l_shipdate", "l_linestatus"])
    return best.select("patient", F.col("l_shipdate").cast("date").alias("date_deces"), F.when(F.col("l_linestatus") == "F", F.lit(True)).alias("hosp"))


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First score of each patient: admission type, points and the predicted
    mortality parsed from its text."""
    o = read_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.concat(F.lit("Mortalité prédite : "), (F.col("o_orderkey") % 100).cast("string"), F.lit(",5%")))
    first = R.first_per_key(o.withColumn("text", text), ["o_custkey"], [("o_orderdate", False), ("o_orderkey", False)], ["o_orderpriority", "o_totalprice", "text"])
    kinds = F.create_map(*[F.lit(v) for kv in ADMISSION.items() for v in kv])
    return first.select(F.col("o_custkey").alias("patient"), kinds[F.substring("o_orderpriority", 1, 1)].alias("admission_type"),
                        F.floor(F.col("o_totalprice") / 5000).alias("sapsii"), r6(parse_percent("text")).alias("sapsii_prob"))


def latest_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").filter(F.col(FEATURE) == "error")
    return R.first_per_key(ev, [ENTITY], [(TIME, True), ("event_id", True)], [TEXT_VALUE]).select(F.col(ENTITY).alias("patient"), F.col(TEXT_VALUE).alias("note"))


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The static encounter table, identifying columns included."""
    longest = F.struct(F.col("hours").isNotNull().cast("int").alias("a"), (-F.coalesce("hours", F.lit(0.0))).alias("b"), F.col("stay").alias("c"))
    e = census(spark, sf_dir).groupBy("encounter", "patient", "age", "gender", "zone", "height").agg(
        F.min("in_time").alias("in_time"), F.max("out_time").alias("out_time"), F.min_by("unit", longest).alias("unit"),
        F.min_by("weight", F.struct("in_time", "stay")).alias("weight"))
    e = e.join(death_registry(spark, sf_dir), "patient", "left").join(severity(spark, sf_dir), "patient", "left").join(latest_note(spark, sf_dir), "patient", "left")
    return e.select("encounter", "patient", "age", "gender", "zone", "unit", "height", "weight", "in_time", "out_time",
                    F.round(hours_between("in_time", "out_time"), 2).alias("los"), "date_deces", F.col("date_deces").isNotNull().alias("is_deceased"),
                    F.col("hosp").isNotNull().alias("deces_hosp"),
                    whole_days_between("in_time", F.col("date_deces").cast("timestamp_ntz")).alias("deces_datediff"),
                    "admission_type", "sapsii", "sapsii_prob", "note")


_IN_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_KINDS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ADMISSION.items())
CENSUS_CTES = f"""{C.STAYS_CTE},
census AS (SELECT TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS encounter, c_custkey AS patient, CAST(floor(c_acctbal / 100) AS BIGINT) AS age,
  c_nationkey % 2 AS gender, c_nationkey AS zone, 150 + c_custkey % 50 AS height, 40 + o_orderkey % 80 AS weight, o_orderpriority AS unit, in_time, out_time,
  date_sub('minute', in_time, out_time) / 60.0 AS hours, o_orderkey AS stay
  FROM stays JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority IN ({_IN_UNITS}) AND floor(c_acctbal / 100) >= {ADULT})"""
ENCOUNTER_CTES = f"""{CENSUS_CTES},
e0 AS (SELECT encounter, patient, age, gender, zone, height, min(in_time) AS in_time, max(out_time) AS out_time,
  arg_min(unit, (CAST(hours IS NOT NULL AS INTEGER), -coalesce(hours, 0.0), stay)) AS unit, arg_min(weight, (in_time, stay)) AS weight FROM census GROUP BY ALL),
reg AS (SELECT o_custkey AS patient, CAST(l_shipdate AS DATE) AS date_deces, CASE WHEN l_linestatus = 'F' THEN TRUE END AS hosp FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY l_quantity DESC, l_shipdate, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity >= {FULL}) WHERE rn = 1),
igs AS (SELECT o_custkey AS patient, CASE substr(o_orderpriority, 1, 1) {_KINDS} END AS admission_type, CAST(floor(o_totalprice / 5000) AS BIGINT) AS sapsii,
  round(CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_orderkey % 100) || '.5' AS DOUBLE) / 100.0 END, 6) AS sapsii_prob FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1),
note AS (SELECT user_id AS patient, props AS note FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'error') WHERE rn = 1),
enc AS (SELECT e0.encounter, e0.patient, age, gender, zone, unit, height, weight, in_time, out_time, round(date_sub('minute', in_time, out_time) / 60.0, 2) AS los,
  date_deces, date_deces IS NOT NULL AS is_deceased, hosp IS NOT NULL AS deces_hosp, date_sub('day', in_time, CAST(date_deces AS TIMESTAMP)) AS deces_datediff,
  admission_type, sapsii, sapsii_prob, note
  FROM e0 LEFT JOIN reg ON reg.patient = e0.patient LEFT JOIN igs ON igs.patient = e0.patient LEFT JOIN note ON note.patient = e0.patient)"""


@query("static_encounters", sql=f"WITH {ENCOUNTER_CTES}\nSELECT * FROM enc")
def static_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static encounter table: cleaned ids, listed units, adults, one row
    per encounter with first entry, last exit and the unit of the longest
    stay, registry death, severity score and latest note, length of stay,
    death flags and days to death."""
    return encounters(spark, sf_dir)


@query("identity_export", sql=f"WITH {CENSUS_CTES}\nSELECT patient, min(in_time) AS in_time FROM census GROUP BY patient")
def identity_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adults of the listed units, each patient once with the entry time,
    to be matched with a registry."""
    return census(spark, sf_dir).groupBy("patient").agg(F.min("in_time").alias("in_time"))


#: columns that identify a patient
IDENTIFYING = ["encounter", "patient", "zone", "in_time", "out_time", "date_deces"]


@query("pseudonymised_encounters", sql=f"""WITH {ENCOUNTER_CTES}
SELECT TRUE AS pseudo_ok, age, gender, unit, height, weight, los, is_deceased, deces_hosp, deces_datediff, admission_type, sapsii, sapsii_prob, note,
       CAST(year(in_time) AS INTEGER) AS year_in FROM enc""")
def pseudonymised_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounter table without its identifying columns, with the
    year of entry and a keyed pseudonym (told here only as well formed, as it
    depends on the session's key)."""
    e = encounters(spark, sf_dir).withColumn("year_in", F.year("in_time"))
    out = PV.pseudonymise(e, "encounter", IDENTIFYING, PV.pseudonym_key(spark))
    return out.select(PV.well_formed("pseudo_id").alias("pseudo_ok"), *[c for c in out.columns if c != "pseudo_id"])


@query("pseudonym_round_trip", sql=f"""WITH {ENCOUNTER_CTES}
SELECT encounter, patient, zone, in_time, out_time, date_deces, age, sapsii, CAST(1 AS BIGINT) AS n_matches FROM enc""")
def pseudonym_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudonymised table led back to its identities by the
    correspondence table: every encounter once."""
    e = encounters(spark, sf_dir)
    key = PV.pseudonym_key(spark)
    table = PV.correspondence(e, "encounter", IDENTIFYING, key)
    back = PV.pseudonymise(e, "encounter", IDENTIFYING, key).join(table, "pseudo_id")
    n = back.groupBy("pseudo_id").agg(F.count(F.lit(1)).alias("n_matches"))
    return back.join(n, "pseudo_id").select(*IDENTIFYING, "age", "sapsii", "n_matches")


DESCRIBED = {"numeric": ["age", "bmi", "los_days", "sapsii"], "categorical": ["gender", "admission_type", "is_deceased"]}


def _table_one_sql(source: str) -> str:
    cat = [f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level, count(*) AS n, round(count(*) * 100.0 / (SELECT count({c}) FROM {source}), 1) AS pct, "
           f"NULL::DOUBLE AS mean, NULL::DOUBLE AS sd FROM {source} WHERE {c} IS NOT NULL GROUP BY 2" for c in DESCRIBED["categorical"]]
    num = [f"SELECT '{c}', NULL, count({c}), NULL, round(avg({c}), 6), round(stddev_samp({c}), 6) FROM {source}" for c in DESCRIBED["numeric"]]
    return "\nUNION ALL ".join(cat + num)


@query("cohort_description", sql=f"""WITH {cohort_ctes()},
{ENCOUNTER_CTES},
demo AS (SELECT *, CAST(year(in_time) AS INTEGER) AS year_in, CAST(month(out_time) AS INTEGER) AS month_out,
  round(weight / ((height / 100.0) * (height / 100.0)), 1) AS bmi, round(los / 24, 1) AS los_days FROM enc WHERE patient IN (SELECT user_id FROM cp))
{_table_one_sql("demo")}""")
def cohort_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort's encounters with year and month, body mass index and
    days of stay, described as a table one."""
    ids = C.cohort_panel(spark, sf_dir).select(F.col(ENTITY).alias("patient")).distinct()
    demo = encounters(spark, sf_dir).join(ids, "patient", "left_semi").withColumns({
        "year_in": F.year("in_time"), "month_out": F.month("out_time"), "bmi": F.round(bmi("weight", "height"), 1), "los_days": F.round(F.col("los") / 24, 1)})
    return ST.table_one(demo, DESCRIBED["categorical"], DESCRIBED["numeric"])


# --------------------------------------------------------------------------
# first day, modelling
# --------------------------------------------------------------------------

DAY_MEANS = ["heart_rate", "pam_invasive", "pam_non_invasive", "fio2"]
#: minutes of a bin; the driver's events are too sparse for hours
BIN = 1440.0
DAY_CTES = f"""h0 AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
hb AS (SELECT e.*, CAST(floor(date_sub('minute', h0.t0, e.ts) / {BIN}) AS BIGINT) AS bin FROM events e JOIN h0 ON e.user_id = h0.user_id),
hbc AS (SELECT user_id, bin, {QP._CLASS_SQL} FROM hb WHERE event_type IN ({QP._CLASS_SRCS}) GROUP BY user_id, bin),
dw AS (SELECT * FROM hbc WHERE bin BETWEEN 0 AND 24 AND user_id IN (SELECT user_id FROM hbc GROUP BY user_id HAVING max(bin) >= 16)),
dm AS (SELECT user_id, mode_vent, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, mode_vent) AS rn FROM dw WHERE mode_vent IS NOT NULL GROUP BY user_id, mode_vent),
dg AS (SELECT user_id, max(bin) AS last_bin, {", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in DAY_MEANS)},
  round(sum(urine_output), 6) AS urine_output FROM dw GROUP BY user_id),
day1 AS (SELECT dg.* REPLACE (coalesce(fio2_mean, 21.0) AS fio2_mean, coalesce(fio2_std, 0.0) AS fio2_std), coalesce(dm.mode_vent, 'none') AS mode_vent,
  e.gender, e.age, e.admission_type, e.los, coalesce(e.deces_datediff < 30, FALSE) AS inf_j30
  FROM dg LEFT JOIN dm ON dm.user_id = dg.user_id AND dm.rn = 1 JOIN enc e ON e.patient = dg.user_id
  WHERE e.gender IS NOT NULL AND e.age IS NOT NULL AND e.admission_type IS NOT NULL AND e.los IS NOT NULL
    AND {" AND ".join(f"dg.{c}_{k} IS NOT NULL" for c in DAY_MEANS if c != "fio2" for k in ("mean", "std"))})"""


@query("first_day_table", sql=f"WITH {ENCOUNTER_CTES},\n{DAY_CTES}\nSELECT * FROM day1")
def first_day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelling table of the first 24 bins: stays reaching bin 16, last
    bin, mean and deviation of all variables, volume, most frequent mode,
    default oxygen, joined to the static encounter with the 30-day outcome;
    rows with a missing value dropped."""
    meas = measurements(spark, sf_dir)
    binned = meas.join(P.first_chart_origin(meas, ENTITY, TIME, "t0"), ENTITY).withColumn("bin", F.floor(minutes_between("t0", TIME) / F.lit(BIN)))
    hp = P.classwise_reduce(binned, [ENTITY, "bin"], FEATURE, VALUE, TEXT_VALUE, TIME, [(s, f, c) for s, f, c, _col in EVENT_FEATURES])
    reach = hp.groupBy(ENTITY).agg(F.max("bin").alias("_mx")).filter(F.col("_mx") >= 16)
    w = hp.filter(F.col("bin").between(0, 24)).join(reach, ENTITY, "left_semi")
    stats = [f(F.col(c)) for c in DAY_MEANS for f in (lambda x, c=c: r6(F.avg(x)).alias(f"{c}_mean"), lambda x, c=c: r6(F.stddev_samp(x)).alias(f"{c}_std"))]
    g = w.groupBy(ENTITY).agg(F.max("bin").alias("last_bin"), *stats, r6(F.sum("urine_output")).alias("urine_output"),
                              F.mode("mode_vent", deterministic=True).alias("mode_vent"))
    g = g.na.fill({"fio2_mean": 21.0, "fio2_std": 0.0, "mode_vent": "none"})
    e = encounters(spark, sf_dir).select(F.col("patient").alias(ENTITY), "gender", "age", "admission_type", "los",
                                         F.coalesce(F.col("deces_datediff") < 30, F.lit(False)).alias("inf_j30"))
    return g.join(e, ENTITY).na.drop()


MODEL_CATS = ["mode_vent", "gender", "admission_type"]
MODEL_NUMS = ["age", *[f"{c}_{k}" for c in DAY_MEANS for k in ("mean", "std")]]


@query("model_frame", sql=f"""WITH {ENCOUNTER_CTES},
{DAY_CTES},
r AS (SELECT *, row_number() OVER (PARTITION BY inf_j30 ORDER BY {QM._key_hash_sql("user_id", 42, 1000003)}, user_id) - 1 AS rk, count(*) OVER (PARTITION BY inf_j30) AS n FROM day1)
SELECT user_id, CAST(inf_j30 AS INTEGER) AS inf_j30, CAST(urine_output > 0 AS INTEGER) AS urine_any,
       {", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}" for c in MODEL_CATS)},
       {", ".join(f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END, 6) AS {c}" for c in MODEL_NUMS)},
       CASE WHEN rk / n < 0.6 THEN 'train' WHEN rk / n < 0.8 THEN 'val' ELSE 'test' END AS split FROM r""")
def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model matrix of the 24 h table with a fixed schema: binarised
    volume, encoded categories, scaled numbers, outcome, stratified split
    (``model_features`` has the variance inflation filter)."""
    x = first_day_table(spark, sf_dir)
    for c in MODEL_CATS:
        x = MD.label_encode(x.withColumnRenamed(c, f"_{c}"), f"_{c}", c).drop(f"_{c}")
    stats = x.agg(*[F.avg(c).alias(f"_m_{c}") for c in MODEL_NUMS], *[F.stddev_pop(c).alias(f"_s_{c}") for c in MODEL_NUMS])
    x = ST.attach_row(MD.stratified_split(x, ENTITY, "inf_j30"), stats)
    scaled = [r6((F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)).alias(c) for c in MODEL_NUMS]
    return x.select(ENTITY, F.col("inf_j30").cast("int").alias("inf_j30"), (F.col("urine_output") > 0).cast("int").alias("urine_any"), *MODEL_CATS, *scaled, "split")


@query("model_features")
def model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance inflation of the scaled features of ``model_frame``
    and which stay (below 10)."""
    v = MD.vif(model_frame(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in ["urine_any", *MODEL_CATS]}), ["urine_any", *MODEL_CATS, *MODEL_NUMS])
    return literal_table(spark, [(c, round(x, 6), bool(x < 10)) for c, x in v], "feature string, vif double, keep boolean")


# --------------------------------------------------------------------------
# text-selected cohort
# --------------------------------------------------------------------------

NOTE_PATTERN = r'"k": [0-6]'
SEPSIS_SPEC = {"heart_rate": ["max", "min"], "pam_invasive": ["max", "min"], "fio2": ["min"], "pam_non_invasive": ["max", "min"], "urine_output": ["mean"]}
SEPSIS_SAMPLE = 2288


@query("sepsis_table", sql=f"""WITH {ENCOUNTER_CTES},
{QC.HPC_CTES},
pop AS (SELECT * FROM enc WHERE coalesce(regexp_matches(note, '{NOTE_PATTERN}'), FALSE)),
w AS (SELECT hpc.* REPLACE (coalesce(pam_non_invasive, 0.0) AS pam_non_invasive) FROM hpc
      WHERE hour BETWEEN 0 AND 120 AND user_id IN (SELECT patient FROM pop) AND heart_rate IS NOT NULL),
g AS (SELECT user_id, {", ".join((f"round(avg({c}), 6)" if f == "mean" else f"{f}({c})") + f" AS {c}_{f}" for c, fs in SEPSIS_SPEC.items() for f in fs)} FROM w GROUP BY user_id)
SELECT TRUE AS pseudo_ok, gender, age, weight, height, sapsii, los, deces_datediff, g.* EXCLUDE (user_id) FROM pop JOIN g ON g.user_id = pop.patient
WHERE sapsii IS NOT NULL ORDER BY {digest_sql('11', 'patient')}, patient LIMIT {SEPSIS_SAMPLE}""")
def sepsis_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters chosen by their note, hours 0..120, dose 0 where
    unknown, hours without the lead variable dropped, several functions per
    column, joined to the static data, keyed pseudonym, rows without a score
    dropped, sample of 2,288."""
    pop = encounters(spark, sf_dir).filter(F.coalesce(F.col("note").rlike(NOTE_PATTERN), F.lit(False)))
    hp = QP.hourly_panel_classwise(spark, sf_dir).filter(F.col("hour").between(0, 120))
    w = hp.join(pop.select(F.col("patient").alias(ENTITY)), ENTITY, "left_semi").na.fill({"pam_non_invasive": 0.0}).filter(F.col("heart_rate").isNotNull())
    g = ST.multi_agg(w, [ENTITY], SEPSIS_SPEC)
    x = pop.join(g.withColumnRenamed(ENTITY, "patient"), "patient").filter(F.col("sapsii").isNotNull())
    x = x.withColumn("_h", digest(11, F.col("patient"))).orderBy("_h", "patient").limit(SEPSIS_SAMPLE)
    x = x.withColumn("pseudo_ok", PV.well_formed(PV.pseudonym("patient", PV.pseudonym_key(spark))))
    return x.select("pseudo_ok", "gender", "age", "weight", "height", "sapsii", "los", "deces_datediff", *[f"{c}_{f}" for c, fs in SEPSIS_SPEC.items() for f in fs])


@query("initial_unit_diagnosis", sql=f"""WITH {ENCOUNTER_CTES},
rum AS (SELECT o_custkey AS patient, l_orderkey, l_partkey AS main_code, l_suppkey AS linked_code, CAST(l_shipdate AS DATE) AS entry, l_returnflag = 'R' AS died,
  row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate DESC, l_orderkey, l_partkey, l_suppkey) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1)
SELECT enc.patient, unit, enc.in_time, rum.entry, main_code, linked_code, rum.died FROM enc JOIN rum ON rum.patient = enc.patient AND rum.rn = 1""")
def initial_unit_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis rows of the initial unit (first line), the last entry of
    each patient with its death flag, joined to the encounter."""
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient"))
    rum = R.first_per_key(li.join(o, "l_orderkey"), ["patient"], [("l_shipdate", True), ("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False)],
                          ["l_shipdate", "l_partkey", "l_suppkey", "l_returnflag"])
    return encounters(spark, sf_dir).join(rum, "patient").select(
        "patient", "unit", "in_time", F.col("l_shipdate").cast("date").alias("entry"), F.col("l_partkey").alias("main_code"),
        F.col("l_suppkey").alias("linked_code"), (F.col("l_returnflag") == "R").alias("died"))


# --------------------------------------------------------------------------
# sequences and outcomes
# --------------------------------------------------------------------------

EARLIEST = 5


def targets(days_to_death: Column, day: Column) -> dict[str, Column]:
    """Days to death are at least 5; death within 24 h of the bin;
    alive after 90 days (unknown: alive)."""
    d = F.when(days_to_death < EARLIEST, F.lit(EARLIEST)).otherwise(days_to_death)
    return {"deces_datediff": d, "death_24h": F.coalesce(d - day < 1, F.lit(False)), "j90_survival": F.coalesce(d >= 90, F.lit(True))}


SLICE = 3


@query("sequence_frame", sql=f"""WITH {cohort_ctes()},
{ENCOUNTER_CTES},
{fill_ctes("cp", "sf", [(c, "both") for c in D])},
x AS (SELECT sf.user_id, sf.day, {", ".join(f"sf.{c}" for c in D)}, e.gender, e.age, e.los,
  CASE WHEN deces_datediff < {EARLIEST} THEN {EARLIEST} ELSE deces_datediff END AS dd FROM sf JOIN enc e ON e.patient = sf.user_id),
y AS (SELECT *, coalesce(dd >= 90, TRUE) AS j90 FROM x),
s0 AS (SELECT user_id, j90, row_number() OVER (PARTITION BY j90 ORDER BY {QM._key_hash_sql("user_id", 42, 1000003)}, user_id) - 1 AS rk, count(*) OVER (PARTITION BY j90) AS n
  FROM (SELECT DISTINCT user_id, j90 FROM y)),
s AS (SELECT user_id, CASE WHEN rk / n < 0.7 THEN 'train' ELSE 'test' END AS split FROM s0),
z AS (SELECT y.*, s.split FROM y JOIN s ON s.user_id = y.user_id),
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in [*D, "age"])} FROM z WHERE split = 'train')
SELECT z.user_id, z.day, {", ".join(f"round((z.{c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}" for c in [*D, "age"])},
  CAST(z.gender AS INTEGER) AS gender, z.split, z.day < {SLICE} AS early, z.day >= {C.COHORT_DAYS - SLICE} AS late, z.dd AS deces_datediff,
  CAST(coalesce(z.dd - z.day < 1, FALSE) AS INTEGER) AS death_24h, CAST(z.j90 AS INTEGER) AS j90_survival, z.los FROM z CROSS JOIN st""")
def sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence inputs with targets: filled cohort series joined to the
    encounter, days to death at least 5, death within a day of the bin, 90-day
    survival; entity split stratified by survival (70/30), numbers scaled on
    the training rows, one row per entity and bin, early and late slices."""
    x = S.interpolate(C.cohort_panel(spark, sf_dir).select(ENTITY, "day", *D), ENTITY, "day", D, "both")
    e = encounters(spark, sf_dir).select(F.col("patient").alias(ENTITY), "gender", "age", "los", F.col("deces_datediff").alias("_dd"))
    x = x.join(e, ENTITY).dropDuplicates([ENTITY, "day"])
    x = x.withColumns(targets(F.col("_dd"), F.col("day"))).drop("_dd")
    who = x.select(ENTITY, "j90_survival").distinct()
    split = MD.stratified_split(who, ENTITY, "j90_survival", fractions=(0.7, 0.7)).select(ENTITY, "split")
    x = x.join(split, ENTITY)
    nums = [*D, "age"]
    st = x.filter("split = 'train'").agg(*[F.avg(c).alias(f"_m_{c}") for c in nums], *[F.stddev_pop(c).alias(f"_s_{c}") for c in nums])
    x = ST.attach_row(x, st)
    scaled = [r6((F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)).alias(c) for c in nums]
    return x.select(ENTITY, "day", *scaled, F.col("gender").cast("int").alias("gender"), "split", (F.col("day") < SLICE).alias("early"),
                    (F.col("day") >= C.COHORT_DAYS - SLICE).alias("late"), "deces_datediff", F.col("death_24h").cast("int").alias("death_24h"),
                    F.col("j90_survival").cast("int").alias("j90_survival"), "los")


OUTCOME_FEATURES = ["mean", "std", "slope", "entropy", "mean_crossings", "peak_to_peak"]


@query("outcome_frame", sql=f"""WITH {ENCOUNTER_CTES},
f AS ({ORACLES["series_profile"]}),
w AS (SELECT user_id, {", ".join(f"max(CASE WHEN feature = '{c}' THEN {k} END) AS {c}_{k}" for c in D for k in OUTCOME_FEATURES)} FROM f GROUP BY user_id)
SELECT w.*, e.gender, e.age, e.admission_type, e.unit, e.is_deceased AS death, e.los AS icu_hours, {QM._split_sql("w.user_id")} AS split
FROM w JOIN enc e ON e.patient = w.user_id""")
def outcome_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entity with features of all four series (first-row
    static columns and targets joined on the key), and the split."""
    f = QM.series_profile(spark, sf_dir)
    wide = f.groupBy(ENTITY).agg(*[F.max(F.when(F.col("feature") == c, F.col(k))).alias(f"{c}_{k}") for c in D for k in OUTCOME_FEATURES])
    e = encounters(spark, sf_dir).select(F.col("patient").alias(ENTITY), "gender", "age", "admission_type", "unit",
                                         F.col("is_deceased").alias("death"), F.col("los").alias("icu_hours"))
    return wide.join(e, ENTITY).select(*wide.columns, "gender", "age", "admission_type", "unit", "death", "icu_hours", MD.hash_split(F.col(ENTITY)).alias("split"))


SELECT_KEYS = [*OUTCOME_FEATURES, "skewness", "kurtosis"]
SELECT_COLS = [f"{c}_{k}" for c in D for k in SELECT_KEYS]
CORRELATED = 0.95


@query("feature_selection", sql=f"""WITH f AS ({ORACLES["series_profile"]}),
w AS (SELECT user_id, {", ".join(f"max(CASE WHEN feature = '{c}' THEN {k} END) AS {c}_{k}" for c in D for k in SELECT_KEYS)} FROM f GROUP BY user_id),
x AS (SELECT * FROM w WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SELECT_COLS)}),
l AS ({" UNION ALL ".join(f"SELECT user_id, {i} AS i, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM x" for i, c in enumerate(SELECT_COLS))}),
v AS (SELECT i, name, var_pop(v) AS variance FROM l GROUP BY i, name),
c AS (SELECT b.i FROM l a JOIN l b ON a.user_id = b.user_id AND a.i < b.i GROUP BY a.i, b.i
      HAVING stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0 AND abs(corr(a.v, b.v)) > {CORRELATED})
SELECT name, round(variance, 6) AS variance, CASE WHEN i IN (SELECT i FROM c) THEN 'correlated' WHEN NOT variance > 0 THEN 'constant'
  WHEN ends_with(name, '_skewness') OR ends_with(name, '_kurtosis') THEN 'suffix' ELSE 'kept' END AS decision FROM v""")
def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series features of all variables: dropped if correlated beyond
    0.95 with an earlier one (one p x p matrix on the driver), constant, or
    named by shape only."""
    f = QM.series_profile(spark, sf_dir)
    wide = f.groupBy(ENTITY).agg(*[F.max(F.when(F.col("feature") == c, F.col(k))).cast("double").alias(f"{c}_{k}") for c in D for k in SELECT_KEYS])
    out = MD.select_features(wide.select(*SELECT_COLS).na.drop(), SELECT_COLS, CORRELATED, ("_skewness", "_kurtosis"))
    return literal_table(spark, [(n, round(v, 6), d) for n, v, d in out], "name string, variance double, decision string")


# --------------------------------------------------------------------------
# panels
# --------------------------------------------------------------------------

WEEK_GRID, WEEK = 180, 168


@query("week_panel", sql=f"""
WITH {hourly_ctes()},
{hourly_wide_cte()},
g AS (SELECT u.user_id, h.hour FROM (SELECT DISTINCT user_id FROM hm) u CROSS JOIN range(0, {WEEK_GRID}) h(hour)),
d AS (SELECT g.user_id, g.hour, {", ".join("hw." + f for f in HF)} FROM g LEFT JOIN hw ON g.user_id = hw.user_id AND g.hour = hw.hour),
o AS (SELECT user_id, min(CASE WHEN {" OR ".join(f + " IS NOT NULL" for f in HF)} THEN hour END) AS t0 FROM d GROUP BY user_id)
SELECT d.user_id, d.hour - o.t0 AS hour, {", ".join("d." + f for f in HF)}
FROM d JOIN o ON d.user_id = o.user_id WHERE o.t0 IS NOT NULL AND d.hour >= o.t0 AND d.hour - o.t0 < {WEEK}""")
def week_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid of 180 hours per entity, all features joined, moved to the
    first hour with a value, one week kept."""
    grid = P.fixed_grid(C.hourly_long(spark, sf_dir), ENTITY, "hour", WEEK_GRID)
    wide = grid.join(C.hourly_wide(spark, sf_dir), [ENTITY, "hour"], "left")
    moved = P.reorigin(wide, ENTITY, "hour", ~all_null(HF)).filter(F.col("hour") < WEEK)
    return moved.select(ENTITY, "hour", *HF)


@query("clean_series", sql=f"""
WITH {hourly_ctes()},
inv AS (SELECT user_id, hour, median_value AS v FROM hm WHERE feature = 'pam_invasive'),
non AS (SELECT user_id, hour, median_value AS v FROM hm WHERE feature = 'pam_non_invasive'),
m AS (SELECT user_id, hour, 'pam' AS feature, coalesce(inv.v, non.v) AS value FROM inv FULL JOIN non USING (user_id, hour)
      UNION ALL SELECT user_id, hour, feature, median_value FROM hm WHERE feature NOT IN ('pam_invasive', 'pam_non_invasive')),
g AS (SELECT user_id, feature, UNNEST(generate_series(0, mx)) AS hour FROM (SELECT user_id, feature, max(hour) AS mx FROM m GROUP BY user_id, feature) WHERE mx >= 0)
SELECT g.user_id, g.feature, g.hour, m.value FROM g LEFT JOIN m ON m.user_id = g.user_id AND m.feature = g.feature AND m.hour = g.hour""")
def clean_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the cleaning chain for all features in one long table: trimmed
    hourly medians (T3), the two pressures merged (T4), every hour from 0 to
    the series' last (T1)."""
    hm = C.hourly_long(spark, sf_dir)
    pressure = F.col("feature").isin("pam_invasive", "pam_non_invasive")
    merged = hm.withColumn("series", F.when(pressure, F.lit("pam")).otherwise(F.col("feature"))).groupBy(ENTITY, "series", "hour").agg(
        F.coalesce(F.max(F.when(F.col("feature") != "pam_non_invasive", F.col("median_value"))), F.max("median_value")).alias("value"))
    key = merged.withColumn("_key", F.struct(ENTITY, "series")).drop(ENTITY, "series")
    dense = P.densify(key, "_key", "hour", 0)
    return dense.select(F.col("_key")[ENTITY].alias(ENTITY), F.col("_key.series").alias("feature"), "hour", "value")


@query("drop_empty_rows", sql=f"""
WITH {QC.HPC_CTES},
z AS (SELECT user_id, hour, heart_rate, pam_invasive, pam_non_invasive, fio2, nullif(urine_output, 0) AS urine_output, mode_vent FROM hpc)
SELECT *, (heart_rate IS NOT NULL OR pam_invasive IS NOT NULL OR pam_non_invasive IS NOT NULL) AS any_vital FROM z
WHERE heart_rate IS NOT NULL OR pam_invasive IS NOT NULL OR pam_non_invasive IS NOT NULL OR fio2 IS NOT NULL OR urine_output IS NOT NULL OR mode_vent IS NOT NULL""")
def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero volumes to null, then rows with every feature null
    dropped; whether any vital sign is there."""
    cols = ["heart_rate", "pam_invasive", "pam_non_invasive", "fio2", "urine_output", "mode_vent"]
    z = QP.hourly_panel_classwise(spark, sf_dir).withColumn("urine_output", F.nullif("urine_output", F.lit(0.0))).select(ENTITY, "hour", *cols)
    return z.filter(~all_null(cols)).withColumn("any_vital", ~all_null(cols[:3]))
