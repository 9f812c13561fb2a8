"""Feature operators: lags, filters, frozen dummy encoder, logs, powers,
imputation, calendar terms and the end-to-end ``prepare`` (W2-W3, E1-E9,
F11-F19, P7-P15).

Everything is a projection except the lag window (one shuffle by the series
key, each window partition bounded by the weeks of the period) and the
encoder fit (one small ``distinct`` per column, size-checked).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.config import PrepConfig
from demandlab.functions.scalar import (holiday_flag, ln_pos, not_in_weeks, round_half_even,
                                        to_percent, week_number)

MAX_LEVELS = 10_000


def lag_name(c: str, k: int) -> str:
    return f"{c}_t_{k}"


def add_lags(df: DataFrame, cols: Sequence[str], n: int, keys: Sequence[str], order: str,
             dropna: bool = False) -> DataFrame:
    """Columns ``<c>_t_1 .. <c>_t_n`` = value k rows earlier within ``keys`` by ``order``.

    Lags count rows, not weeks: build them on the gap-free panel, before any
    row is removed. ``dropna`` keeps only rows whose lags all exist (W3).
    """
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumns({lag_name(c, k): F.lag(c, k).over(w) for c in cols for k in range(1, n + 1)})
    if dropna:
        out = out.dropna(subset=[lag_name(c, k) for c in cols for k in range(1, n + 1)])
    return out


def require_lags(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose longest lag exists."""
    return df.where(F.col(col).isNotNull())


def drop_zero_demand(df: DataFrame, col: str) -> DataFrame:
    """Remove rows without positive demand, after lags and before logs."""
    return df.where(F.col(col) > 0)


def drop_weeks(df: DataFrame, col: str, weeks: Iterable[date]) -> DataFrame:
    """Drop outlier weeks; rows with a NULL week are kept."""
    return df.where(not_in_weeks(col, weeks))


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Drop one category (P10); NULL categories are kept."""
    return df.where(F.col(col).isNull() | (F.col(col) != F.lit(value)))


def below(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Optional threshold filter, e.g. unavailability < 0.25."""
    return df.where(F.col(col) < F.lit(threshold))


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None, prefix: str | None = None,
           cols: Iterable[str] | None = None) -> DataFrame:
    """Rename by dictionary, or prefix a column set."""
    if prefix is not None:
        mapping = {c: prefix + c for c in (cols or df.columns)}
    return df.withColumnsRenamed(dict(mapping or {}))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> 0 on a column set."""
    return df.fillna(0, subset=list(cols))


def to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast a column set to string."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def add_logs(df: DataFrame, cols: Sequence[str], prefix: str = "l_") -> DataFrame:
    """``l_<c>`` = ln(c), NULL where c <= 0 or NULL."""
    return df.withColumns({prefix + c: ln_pos(c) for c in cols})


def add_const(df: DataFrame, name: str = "const") -> DataFrame:
    """Constant 1.0 column; no-op when it exists."""
    return df if name in df.columns else df.withColumn(name, F.lit(1.0))


def power_name(c: str, k: int) -> str:
    return f"{c}_pow{k}"


def add_powers(df: DataFrame, degrees: Mapping[str, int]) -> DataFrame:
    """Per-column powers 2..d, no cross terms and no bias (E5)."""
    return df.withColumns({power_name(c, k): F.pow(F.col(c), F.lit(float(k)))
                           for c, d in degrees.items() for k in range(2, d + 1)})


def impute(df: DataFrame, cols: Sequence[str], how: str = "max", suffix: str = "") -> DataFrame:
    """NULL -> the column's max (or mean) over the valid values (E6); written to
    ``<col><suffix>`` (in place when the suffix is empty).

    One aggregate pass; the per-column statistics (one number each) become literals.
    """
    return fill_values(df, impute_values(df, cols, how), suffix)


def impute_values(df: DataFrame, cols: Sequence[str], how: str = "max") -> dict[str, float]:
    """The values ``impute`` would use; keep them to treat a later set alike."""
    fn = {"max": F.max, "mean": F.avg, "min": F.min}[how]
    return df.agg(*[fn(c).alias(c) for c in cols]).first().asDict()


def fill_values(df: DataFrame, values: Mapping[str, float], suffix: str = "") -> DataFrame:
    return df.withColumns({c + suffix: F.coalesce(F.col(c), F.lit(v).cast("double")) for c, v in values.items()})


def add_week_number(df: DataFrame, week_col: str, origin: date, name: str = "week_nr") -> DataFrame:
    """Weeks since ``origin`` plus one (F16)."""
    return df.withColumn(name, week_number(week_col, origin))


def week_number_from_log(df: DataFrame, log_col: str, name: str = "week_nr") -> DataFrame:
    """Recover the week number from its log, rounded half to even."""
    return df.withColumn(name, round_half_even(F.exp(F.col(log_col))))


def add_holiday(df: DataFrame, week_col: str, holidays: Iterable[date], name: str = "holiday") -> DataFrame:
    """1 for listed holiday weeks, else 0."""
    return df.withColumn(name, holiday_flag(week_col, holidays))


def regime_dummies(df: DataFrame, week_col: str, shift: date, line_col: str,
                   lines: Sequence[str]) -> DataFrame:
    """Price-line x regime dummies: ``post<l>`` after the shift, ``<l>`` before it."""
    post = F.coalesce((F.col(week_col) > F.lit(shift)).cast("int"), F.lit(0))
    cols = {}
    for ln in lines:
        is_l = F.coalesce((F.col(line_col) == F.lit(ln)).cast("int"), F.lit(0))
        cols[regime_name("pre", ln)] = is_l - post * is_l
        cols[regime_name("post", ln)] = post * is_l
    return df.withColumns(cols)


def regime_name(kind: str, line: str) -> str:
    return f"{kind}_{_safe(line)}"


def _safe(s: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(s)).strip("_")


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{_safe(level)}"


@dataclass(frozen=True)
class FrozenDummies:
    """One-hot encoder with the first (alphabetical) level of each column left out.

    ``fit`` reads the levels once (one small distinct per column, size
    checked); ``transform`` is a pure projection, so a later set gets exactly
    the same columns: unseen levels give all-zero rows (E7). The source column
    is kept beside its dummies (E2). ``defaults`` reports the left-out levels (L4).
    """
    levels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    #: Imputation values found when the encoder was fitted: {column: value}.
    fills: Mapping[str, float] = field(default_factory=dict)

    @property
    def names(self) -> dict[tuple[str, str], str]:
        """Dummy name of each (column, level); names that would agree, upper and lower
        case alike, get a digest of the level."""
        plain = {(c, v): dummy_name(c, v) for c, lv in self.levels.items() for v in lv[1:]}
        seen = Counter(n.lower() for n in plain.values())
        return {k: n if seen[n.lower()] == 1 else f"{n}_{hashlib.md5(k[1].encode()).hexdigest()[:6]}" for k, n in plain.items()}

    @staticmethod
    def fit(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> "FrozenDummies":
        """Levels of all columns from one distributed ``distinct`` (one job), size-checked."""
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                    for c in cols])).alias("p")
        cap = max_levels * max(len(cols), 1)
        rows = (df.select(pairs).select("p.c", "p.v").where(F.col("v").isNotNull())
                .distinct().limit(cap + 1).collect())
        if len(rows) > cap:
            raise ValueError(f"more than {max_levels} levels per column on average in {list(cols)}")
        levels = {c: tuple(sorted(r.v for r in rows if r.c == c)) for c in cols}
        for c, lv in levels.items():
            if len(lv) > max_levels:
                raise ValueError(f"column {c} has more than {max_levels} levels")
        return FrozenDummies(levels)

    @property
    def defaults(self) -> dict[str, str | None]:
        return {c: (lv[0] if lv else None) for c, lv in self.levels.items()}

    @property
    def columns(self) -> list[str]:
        return list(self.names.values())

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            name: F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
            for (c, v), name in self.names.items()})

    def decode(self, col: str) -> Column:
        """Dummies of ``col`` -> its label; the left-out level when none is set."""
        lv = self.levels[col]
        out = None
        for v in lv[1:]:
            cond = F.col(self.names[col, v]) == 1
            out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
        return F.lit(lv[0]) if out is None else out.otherwise(F.lit(lv[0]))


def align(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Give ``df`` exactly ``columns``: missing ones are added as ``fill``."""
    missing = {c: F.lit(fill) for c in columns if c not in df.columns}
    return df.withColumns(missing).select(*columns) if missing else df.select(*columns)


def easter_sunday(y: int) -> date:
    """Gregorian Easter Sunday (anonymous Gregorian algorithm)."""
    a, b, c = y % 19, y // 100, y % 100
    d, e = b // 4, b % 4
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    month = (h + l_ - 7 * m + 114) // 31
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return date(y, month, day)


def holiday_weeks(years: Iterable[int]) -> list[date]:
    """Holiday week starts (Mondays) by rule for any years: the week before Easter,
    the first week of May, four summer weeks from the last Monday of July, and two
    Christmas weeks from the first Monday on or after Dec 26. For 2020-2022 this
    gives the weeks listed in ``tests/test_features.py`` inside the study period."""
    from datetime import timedelta
    out = set()
    for y in years:
        out.add(easter_sunday(y) - timedelta(days=6))
        may1 = date(y, 5, 1)
        out.add(may1 + timedelta(days=(7 - may1.weekday()) % 7))
        jul31 = date(y, 7, 31)
        last_jul = jul31 - timedelta(days=jul31.weekday())
        out.update(last_jul + timedelta(weeks=k) for k in range(4))
        dec26 = date(y, 12, 26)
        xmas = dec26 + timedelta(days=(7 - dec26.weekday()) % 7)
        out.update((xmas, xmas + timedelta(weeks=1)))
    return sorted(out)


def prepare(weekly: DataFrame, cfg: PrepConfig = PrepConfig(),
            encoder: FrozenDummies | None = None,
            holidays: Iterable[date] = (), checkpoint: bool = True) -> tuple[DataFrame, FrozenDummies]:
    """Weekly panel -> regression-ready design matrix.

    fill 0 -> lags -> keep rows with the longest lag -> drop zero demand ->
    dummies (frozen encoder, fitted here unless given) -> week number ->
    unavailability in percent -> logs -> regime dummies -> powers -> imputed
    lag logs -> holiday flag -> constant.
    Returns the matrix and the encoder (reuse it on a later period, E7).
    With ``checkpoint`` the filtered rows are written once, as Parquet, to the
    shared folder: the encoder fit and the final projection read them
    instead of recomputing the panel lineage.
    """
    df = fill_zero(weekly, cfg.fill_zero)
    df = add_lags(df, cfg.lag_cols, cfg.n_lags, cfg.keys, cfg.order)
    df = require_lags(df, lag_name(cfg.lag_cols[0], cfg.n_lags))
    if cfg.drop_zero_demand:
        df = drop_zero_demand(df, cfg.lag_cols[0])
    if cfg.outlier_weeks:
        df = drop_weeks(df, "week_start_date", cfg.outlier_weeks)
    if checkpoint:
        from demandlab.session import scratch_table
        path = scratch_table(df.sparkSession, "prepared")
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    enc = encoder or FrozenDummies.fit(df, cfg.dummy_cols)
    df = enc.transform(df)
    df = add_week_number(df, "week_start_date", cfg.week_origin)
    df = df.withColumn("avg_unavailability_perc", to_percent("avg_unavailability_perc"))
    df = add_logs(df, cfg.log_cols)
    if cfg.shift_date is not None:
        df = regime_dummies(df, "week_start_date", cfg.shift_date, "ppl", cfg.regime_lines)
    if cfg.powers:
        df = add_powers(df, dict(cfg.powers))
    if cfg.impute:
        if not enc.fills:  # fitted here; a later set gets the values of the first
            fills: dict[str, float] = {}
            for how in sorted({h for _, h in cfg.impute}):
                fills |= impute_values(df, [c for c, h in cfg.impute if h == how], how)
            enc = replace(enc, fills=fills)
        df = fill_values(df, enc.fills, "_m")
    df = add_holiday(df, "week_start_date", holidays)
    df = add_const(df)
    return df, enc


def design_columns(cfg: PrepConfig) -> list[str]:
    """Names of the derived design columns ``prepare`` adds besides dummies and logs."""
    out = []
    if cfg.shift_date is not None:
        out += [regime_name(k, ln) for ln in cfg.regime_lines for k in ("pre", "post")]
    out += [power_name(c, k) for c, d in cfg.powers for k in range(2, d + 1)]
    out += [c + "_m" for c, _ in cfg.impute]
    return out
