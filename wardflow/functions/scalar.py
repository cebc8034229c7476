"""Scalar column expressions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DP = 6  # decimals kept on computed doubles (float parity with SQL oracles)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column, dp: int = DP) -> Column:
    return F.round(col(c), dp)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", col(start), col(end))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed hours as whole minutes / 60 (sub-minute part dropped)."""
    return minutes_between(start, end) / F.lit(60.0)


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """Number of complete 24 h periods from ``start`` to ``end``."""
    return F.timestamp_diff("DAY", col(start), col(end))


def hour_bin(hours: str | Column) -> Column:
    """Hour bin: truncation toward zero (-0.5 h -> 0, -1.5 h -> -1)."""
    return col(hours).cast("bigint")


def digits_only(c: str | Column) -> Column:
    """Identifier cleaned of every non-digit character."""
    return F.regexp_replace(col(c), r"\D", "")


def parse_percent(c: str | Column) -> Column:
    """``'... : 12,5%'`` -> 0.125; anything unparsable -> null."""
    num = F.regexp_extract(col(c), r"(-?[0-9]+(?:[.,][0-9]+)?)\s*%", 1)
    return F.try_divide(F.regexp_replace(num, ",", ".").try_cast("double"), F.lit(100.0))


def safe_double(c: str | Column) -> Column:
    return col(c).try_cast("double")


def any_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])


def all_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def all_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def null_count(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def first_char(c: str | Column) -> Column:
    return F.substring(col(c), 1, 1)


def first_token(c: str | Column, sep: str) -> Column:
    return F.substring_index(col(c), sep, 1)


# --- fixed values: Abramowitz & Stegun 7.1.26 coefficients (in erf below) ----
def erf(x: str | Column) -> Column:
    """Error function, Abramowitz & Stegun 7.1.26 (|error| < 1.5e-7)."""
    x = col(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * ax)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (
        F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def normal_sf(z: str | Column) -> Column:
    """Upper tail of the standard normal, ``P(Z > z)``."""
    return F.lit(0.5) * (F.lit(1.0) - erf(col(z) / F.lit(2.0 ** 0.5)))


def exp_score(e: str | Column, alpha: float = 0.2) -> Column:
    """Tail score ``1 - exp(-alpha e^2)``."""
    return F.lit(1.0) - F.exp(F.lit(-alpha) * col(e) * col(e))


# --- fixed values: standard normal 0.975 quantile ------------------------------
Z975 = 1.959963984540054


def t_quantile_975(df_col: str | Column) -> Column:
    """Student t 0.975 quantile (two-sided 5 %) for ``df`` degrees of freedom,
    Hill's closed-form algorithm (ACM 396): |error| < 3e-6 at df = 3 and
    ~1e-9 from df = 5; df = 1 and 2 are exact."""
    n = col(df_col).cast("double")
    p = 0.05
    a = F.lit(1.0) / (n - 0.5)
    b = F.lit(48.0) / (a * a)
    c = ((F.lit(20700.0) * a / b - 98) * a - 16) * a + 96.36
    d = ((F.lit(94.5) / (b + c) - 3) / b + 1) * F.sqrt(a * (math.pi / 2)) * n
    y0 = F.pow(d * p, F.lit(2.0) / n)
    x = -Z975
    c1 = c + F.when(n < 5, F.lit(0.3) * (n - 4.5) * (x + 0.6)).otherwise(F.lit(0.0))
    c2 = (((F.lit(0.05) * d * x - 5) * x - 7) * x - 2) * x + b + c1
    yy = x * x
    t1 = (((((0.4 * yy + 6.3) * yy + 36) * yy + 94.5) / c2 - yy - 3) / b + 1) * x
    tail = F.expm1(a * t1 * t1)
    body = (((F.lit(1.0) / (((n + 6) / (n * y0) - F.lit(0.089) * d - 0.822) * (n + 2) * 3)
              + F.lit(0.5) / (n + 4)) * y0 - 1) * (n + 1) / (n + 2) + F.lit(1.0) / y0)
    y = F.when(y0 > a + 0.05, tail).otherwise(body)
    exact1 = math.cos(p * math.pi / 2) / math.sin(p * math.pi / 2)
    exact2 = math.sqrt(2 / (p * (2 - p)) - 2)
    return F.when(n == 1, F.lit(exact1)).when(n == 2, F.lit(exact2)).otherwise(F.sqrt(n * y))


def t_quantile_975_sql(df_expr: str) -> str:
    """The same algorithm as SQL text (oracle side)."""
    n = f"CAST({df_expr} AS DOUBLE)"
    p = 0.05
    a = f"(1.0 / ({n} - 0.5))"
    b = f"(48.0 / ({a} * {a}))"
    c = f"(((20700.0 * {a} / {b} - 98) * {a} - 16) * {a} + 96.36)"
    d = f"(((94.5 / ({b} + {c}) - 3) / {b} + 1) * sqrt({a} * {math.pi / 2!r}) * {n})"
    y0 = f"power({d} * {p}, 2.0 / {n})"
    x = f"CAST({-Z975!r} AS DOUBLE)"
    c1 = f"({c} + CASE WHEN {n} < 5 THEN 0.3 * ({n} - 4.5) * ({x} + 0.6) ELSE 0.0 END)"
    c2 = f"((((0.05 * {d} * {x} - 5) * {x} - 7) * {x} - 2) * {x} + {b} + {c1})"
    yy = f"({x} * {x})"
    t1 = f"((((((0.4 * {yy} + 6.3) * {yy} + 36) * {yy} + 94.5) / {c2} - {yy} - 3) / {b} + 1) * {x})"
    tail = f"(exp({a} * {t1} * {t1}) - 1)"
    body = (f"(((1.0 / ((({n} + 6) / ({n} * {y0}) - 0.089 * {d} - 0.822) * ({n} + 2) * 3) + 0.5 / ({n} + 4)) "
            f"* {y0} - 1) * ({n} + 1) / ({n} + 2) + 1.0 / {y0})")
    y = f"(CASE WHEN {y0} > {a} + 0.05 THEN {tail} ELSE {body} END)"
    exact1 = math.cos(p * math.pi / 2) / math.sin(p * math.pi / 2)
    exact2 = math.sqrt(2 / (p * (2 - p)) - 2)
    return (f"(CASE WHEN {n} = 1 THEN CAST({exact1!r} AS DOUBLE) WHEN {n} = 2 THEN CAST({exact2!r} AS DOUBLE) "
            f"ELSE sqrt({n} * {y}) END)")


def fio2_reconciled(fio2: str | Column, admin_o2: str | Column, o2_flow: str | Column,
                    room_air: str = "air") -> Column:
    """Oxygen fraction: measured value, else 21 on room air, else
    ``4*flow + 21`` when the flow lies in [0, 15], else null."""
    return (F.when(col(fio2).isNotNull(), col(fio2))
            .when(col(admin_o2) == F.lit(room_air), F.lit(21.0))
            .when(col(o2_flow).between(0, 15), F.lit(4.0) * col(o2_flow) + F.lit(21.0)))


def bmi(weight_kg: str | Column, height_cm: str | Column) -> Column:
    h = col(height_cm) / F.lit(100.0)
    return F.try_divide(col(weight_kg), h * h)
