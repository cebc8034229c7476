"""SQL fragments shared by the DuckDB oracles (built from the same fixed
dictionaries the Spark side uses)."""

from __future__ import annotations

from wardflow.functions.dictionary import (CLINICAL_RANGES, EVENT_FEATURES, RANGE_ONLY_FEATURES,
                                           range_key)


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values_cte(name: str, cols: list[str], rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(cols)}) AS (VALUES {body})"


def feature_ranges_ctes() -> str:
    """CTEs ``feats``, ``ranges``, ``fr`` (numeric dictionary features with
    their ranges) and ``bounds`` (trimming bounds, 3 sigma)."""
    feats = values_cte("feats", ["event_type", "feature", "range_feature"],
                       [(s, f, range_key(f)) for s, f, _c, col in EVENT_FEATURES if col == "value"])
    ranges = values_cte("ranges", ["range_feature", "lo", "hi", "range_only"],
                        [(f, lo, hi, f in RANGE_ONLY_FEATURES) for f, lo, hi in CLINICAL_RANGES])
    return f"""{feats},
{ranges},
fr AS (SELECT f.event_type, f.feature, r.lo, r.hi, coalesce(r.range_only, FALSE) AS range_only
       FROM feats f LEFT JOIN ranges r ON f.range_feature = r.range_feature),
stats AS (SELECT e.event_type, avg(e.value) AS m, stddev_samp(e.value) AS s
          FROM events e JOIN fr ON e.event_type = fr.event_type
          WHERE fr.lo IS NULL OR e.value BETWEEN fr.lo AND fr.hi
          GROUP BY e.event_type),
bounds AS (SELECT fr.event_type, fr.feature,
              CASE WHEN fr.range_only THEN fr.lo WHEN fr.lo IS NULL THEN m - 3 * s
                   ELSE greatest(fr.lo, m - 3 * s) END AS lo_b,
              CASE WHEN fr.range_only THEN fr.hi WHEN fr.hi IS NULL THEN m + 3 * s
                   ELSE least(fr.hi, m + 3 * s) END AS hi_b
           FROM fr LEFT JOIN stats ON fr.event_type = stats.event_type)"""


ORIGIN_CTE = """origin AS (SELECT user_id, min(ts) AS origin FROM events
                WHERE event_type = 'signup' GROUP BY user_id)"""

HOURLY_MEDIAN_CTE = """hm AS (
  SELECT user_id, feature, CAST(trunc(dh) AS BIGINT) AS hour, round(median(value), 6) AS median_value
  FROM (SELECT e.user_id, b.feature, e.value, b.lo_b, b.hi_b,
               date_sub('minute', o.origin, e.ts) / 60.0 AS dh
        FROM events e JOIN origin o ON e.user_id = o.user_id
        JOIN bounds b ON e.event_type = b.event_type) x
  WHERE dh >= -1 AND value BETWEEN lo_b AND hi_b
  GROUP BY user_id, feature, CAST(trunc(dh) AS BIGINT))"""


def _daily_cols_sql() -> str:
    from wardflow.plans.common import DAILY
    return ",\n    ".join(f"round(median(CASE WHEN e.event_type = '{s}' THEN e.value END), 6) AS {f}"
                          for s, f in DAILY)


def daily_panel_ctes() -> str:
    """CTEs ``t0``, ``dsparse``, ``dgrid``, ``dp`` (dense daily panel)."""
    from wardflow.plans.common import DAILY
    srcs = ", ".join(f"'{s}'" for s, _f in DAILY)
    cols = ", ".join(f"s.{f}" for _s, f in DAILY)
    return f"""t0 AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
dsparse AS (
  SELECT e.user_id, CAST(floor(date_sub('minute', t0.t0, e.ts) / 1440.0) AS BIGINT) AS day,
    {_daily_cols_sql()}
  FROM events e JOIN t0 ON e.user_id = t0.user_id
  WHERE e.event_type IN ({srcs})
  GROUP BY e.user_id, CAST(floor(date_sub('minute', t0.t0, e.ts) / 1440.0) AS BIGINT)),
dgrid AS (SELECT user_id, UNNEST(generate_series(0, mx)) AS day
          FROM (SELECT user_id, max(day) AS mx FROM dsparse GROUP BY user_id) WHERE mx >= 0),
dp AS (SELECT g.user_id, g.day, {cols}
       FROM dgrid g LEFT JOIN dsparse s ON g.user_id = s.user_id AND g.day = s.day)"""


def cohort_ctes() -> str:
    """``daily_panel_ctes`` + ``dpm``, ``trimmed``, ``coh0``, ``cp`` (cohort)."""
    from wardflow.plans.common import COHORT_DAYS, COHORT_MAX_MISSING, DAILY_COLS
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in DAILY_COLS)
    mx = ", ".join(f"sum(CAST({c} IS NULL AS INTEGER))" for c in DAILY_COLS)
    return f"""{daily_panel_ctes()},
dpm AS (SELECT *, {nulls} AS total_missing FROM dp),
lastv AS (SELECT user_id, max(CASE WHEN total_missing < {len(DAILY_COLS)} THEN day END) AS tl
          FROM dpm GROUP BY user_id),
trimmed AS (SELECT d.* FROM dpm d JOIN lastv l ON d.user_id = l.user_id
            WHERE l.tl IS NOT NULL AND d.day <= l.tl),
mvi AS (SELECT user_id, max(day) AS max_valid_interval FROM trimmed GROUP BY user_id),
coh0 AS (SELECT t.*, m.max_valid_interval FROM trimmed t JOIN mvi m ON t.user_id = m.user_id
         WHERE m.max_valid_interval > {COHORT_DAYS - 1} AND t.day < {COHORT_DAYS}),
sparse_u AS (SELECT user_id FROM coh0 GROUP BY user_id HAVING greatest({mx}) > {COHORT_MAX_MISSING}),
cp AS (SELECT * FROM coh0 WHERE user_id NOT IN (SELECT user_id FROM sparse_u))"""


def hourly_ctes() -> str:
    """bounds + origin + ``hm`` (trimmed hourly medians, long)."""
    return f"{feature_ranges_ctes()},\n{ORIGIN_CTE},\n{HOURLY_MEDIAN_CTE}"


def hourly_wide_cte(name: str = "hw") -> str:
    from wardflow.plans.common import HOURLY_FEATURES
    cols = ",\n  ".join(f"max(CASE WHEN feature = '{f}' THEN median_value END) AS {f}" for f in HOURLY_FEATURES)
    return f"{name} AS (SELECT user_id, hour,\n  {cols}\n  FROM hm GROUP BY user_id, hour)"


def fill_ctes(src: str, name: str, specs: list[tuple[str, str]], keys: str = "user_id", t: str = "day") -> str:
    """CTEs ``{name}_i``, ``{name}_n`` and ``{name}`` filling columns of
    ``src`` per ``(column, mode)``: mode ``both`` / ``inside`` / ``forward``
    (linear interpolation by row position) or ``locf`` (forward then
    backward fill).  Other columns of ``src`` are kept."""
    wa = f"PARTITION BY {keys} ORDER BY {t} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    wf = f"PARTITION BY {keys} ORDER BY {t} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    nb = ",\n  ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN _i END IGNORE NULLS) OVER ({wa}) AS {c}_pi, "
        f"last_value({c} IGNORE NULLS) OVER ({wa}) AS {c}_pv, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN _i END IGNORE NULLS) OVER ({wf}) AS {c}_ni, "
        f"first_value({c} IGNORE NULLS) OVER ({wf}) AS {c}_nv" for c, _m in specs)

    def filled(c, mode):
        inner = f"{c}_pv + ({c}_nv - {c}_pv) * (CAST(_i - {c}_pi AS DOUBLE) / ({c}_ni - {c}_pi))"
        expr = {"both": f"coalesce({inner}, {c}_pv, {c}_nv)", "inside": inner,
                "forward": f"coalesce({inner}, {c}_pv)", "locf": f"coalesce({c}_pv, {c}_nv)"}[mode]
        return f"CASE WHEN {c} IS NOT NULL THEN {c} ELSE {expr} END AS {c}"

    drop = ", ".join(f"{c}_pi, {c}_pv, {c}_ni, {c}_nv" for c, _m in specs)
    cols = ", ".join(c for c, _m in specs)
    return f"""{name}_i AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {t}) AS _i FROM {src}),
{name}_n AS (SELECT *,
  {nb}
  FROM {name}_i),
{name} AS (SELECT * EXCLUDE ({cols}, {drop}, _i), {", ".join(filled(c, m) for c, m in specs)} FROM {name}_n)"""
