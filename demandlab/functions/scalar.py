"""Column -> column expressions. All are built-in Spark expressions (codegen'd).

Missing-value rule of the library: NULL is the only missing value. Logs of
non-positive numbers, divisions by zero and non-finite doubles become NULL,
never NaN or +/-inf.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "iff", "div0", "safe_div", "ln_pos", "finite_or_null", "presence_flag",
    "yes_no_flag", "volume_ml", "key_of_date", "date_of_key", "week_start", "week_key",
    "year_calendar_week", "week_number", "holiday_flag", "not_in_weeks", "regime_line",
    "decode_dummies", "to_percent", "clamp_positive", "round_half_even",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iff(cond: Column, a, b) -> Column:
    """IFF(cond, a, b): a NULL condition takes the ``b`` branch (F1)."""
    return F.when(cond, a).otherwise(b)


def div0(a: str | Column, b: str | Column) -> Column:
    """DIV0: 0 when the divisor is 0 (and the dividend known), NULL if either is NULL."""
    a, b = col_(a), col_(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
             .when(b == 0, F.lit(0.0))
             .otherwise(a.cast("double") / b))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise on ``/``)."""
    return F.try_divide(col_(a).cast("double"), col_(b))


def ln_pos(c: str | Column) -> Column:
    """Natural log, NULL for zero, negative or NULL input (F11, decision D1)."""
    c = col_(c)
    return F.when(c > 0, F.ln(c))


def finite_or_null(c: str | Column) -> Column:
    """Replace NaN and +/-inf by NULL."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def presence_flag(c: str | Column) -> Column:
    """IS NULL -> 0 else 1 (F8)."""
    return col_(c).isNotNull().cast("int")


def yes_no_flag(c: str | Column) -> Column:
    """'yes' -> 1, 'no' -> 0, anything else NULL."""
    c = col_(c)
    return F.when(c == "yes", F.lit(1)).when(c == "no", F.lit(0))


def volume_ml(value: str | Column, uom: str | Column,
              factors: Mapping[str, float] | None = None) -> Column:
    """Content normalised to millilitres; unknown unit -> NULL."""
    factors = factors or {"ml": 1.0, "liter": 1000.0}
    value, uom = col_(value), col_(uom)
    out = None
    for unit, f in factors.items():
        expr = value * F.lit(f) if f != 1.0 else value.cast("double")
        out = F.when(uom == unit, expr) if out is None else out.when(uom == unit, expr)
    return out


def key_of_date(d: str | Column) -> Column:
    """DATE -> int YYYYMMDD date key."""
    d = col_(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_key(k: str | Column) -> Column:
    """int YYYYMMDD -> DATE."""
    return F.to_date(col_(k).cast("string"), "yyyyMMdd")


def week_start(d: str | Column) -> Column:
    """Monday of the week containing ``d`` (date_trunc('week') is Monday-based)."""
    return F.to_date(F.date_trunc("week", col_(d)))


def week_key(d: str | Column) -> Column:
    """Week key: YYYYMMDD of the week's Monday."""
    return key_of_date(week_start(d))


def year_calendar_week(d: str | Column) -> Column:
    """ISO year * 100 + ISO week number."""
    d = col_(d)
    return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("int")


def week_number(week_start_col: str | Column, origin: date) -> Column:
    """Weeks since ``origin`` + 1 as a double: days / 7 + 1 (F16)."""
    return F.datediff(col_(week_start_col), F.lit(origin)) / F.lit(7.0) + F.lit(1.0)


def holiday_flag(week_start_col: str | Column, holidays: Iterable[date]) -> Column:
    """1 when the week start is in the holiday list, else 0."""
    hs = [F.lit(h) for h in holidays]
    c = col_(week_start_col)
    return F.coalesce(c.isin(*hs), F.lit(False)).cast("int") if hs else F.lit(0)


def not_in_weeks(week_start_col: str | Column, weeks: Iterable[date]) -> Column:
    """Predicate keeping rows outside ``weeks``; NULL weeks are kept."""
    c = col_(week_start_col)
    ws = [F.lit(w) for w in weeks]
    if not ws:
        return F.lit(True)
    return c.isNull() | ~c.isin(*ws)


def regime_line(key_date: str | Column, ppl: str | Column, shift_key: int,
                lines: Iterable[str]) -> tuple[Column, Column]:
    """(shift, ppln): 'post'/'pre' against the shift date; after it listed lines
    become 'post<line>' and other lines NULL, before it the line itself (F4/F5)."""
    kd, p = col_(key_date), col_(ppl)
    shift = F.when(kd > F.lit(shift_key), F.lit("post")).otherwise(F.lit("pre"))
    inner = None
    for ln in lines:
        inner = (F.when(p == ln, F.lit("post" + ln)) if inner is None
                 else inner.when(p == ln, F.lit("post" + ln)))
    inner = inner if inner is not None else F.lit(None).cast("string")
    ppln = F.when(shift == "post", inner).otherwise(p)
    return shift, ppln


def decode_dummies(dummy_cols: Mapping[str, str], default: str) -> Column:
    """Several 0/1 columns -> one category label; ``default`` when none is set."""
    out = None
    for c, label in dummy_cols.items():
        out = F.when(F.col(c) == 1, F.lit(label)) if out is None else out.when(F.col(c) == 1, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def to_percent(c: str | Column) -> Column:
    """Ratio -> percent."""
    return col_(c) * F.lit(100.0)


def clamp_positive(c: str | Column) -> Column:
    """IFF(x > 0, x, 0): negatives and NULL become 0 (A3)."""
    c = col_(c)
    return F.when(c > 0, c).otherwise(F.lit(0.0))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """Round half to even, the numpy rule."""
    return F.bround(col_(c), digits)
