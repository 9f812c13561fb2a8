"""Run parameters (the session variables of the panel scripts), frozen.

Dates are plain ``datetime.date``; the panel code turns them into
``YYYYMMDD`` integer keys where it compares with date keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


def date_key(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


@dataclass(frozen=True)
class PanelConfig:
    # panel period, inclusive (key_date BETWEEN start AND end)
    start: date = date(1995, 1, 1)
    end: date = date(2001, 8, 31)
    # later period scored with models fitted on the panel period
    holdout_start: date = date(2001, 1, 1)
    holdout_end: date = date(2001, 8, 31)
    # category level 1 the panel is built for
    category: str = "ECONOMY"
    # assortment window: added on/before the first date, removed after the second (or never)
    in_assortment_from: date = date(1995, 3, 31)
    in_assortment_to: date = date(2001, 8, 31)
    # price line that carries the default price (excluded from the daily panel)
    default_line: str = "5-LOW"
    # price type taken from the price list
    price_type: str = "list"
    # price-line regime change: after this date listed lines become "post<line>"
    shift_date: date = date(1998, 6, 30)
    regime_lines: tuple[str, ...] = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    # upper bound on distinct price lines (checked before lines are expanded)
    max_lines: int = 1000

    @property
    def start_key(self) -> int:
        return date_key(self.start)

    @property
    def end_key(self) -> int:
        return date_key(self.end)

    @property
    def period_days(self) -> int:
        return (self.end - self.start).days + 1


@dataclass(frozen=True)
class PrepConfig:
    """Weekly panel -> design matrix (the data-transformation checklist)."""
    keys: tuple[str, ...] = ("key_article", "ppl")       # lag partition
    order: str = "key_week"                                # lag order
    lag_cols: tuple[str, ...] = ("product_order_amt", "avg_sell_price")
    n_lags: int = 2
    fill_zero: tuple[str, ...] = ("product_order_amt", "avg_unavailability_perc")
    dummy_cols: tuple[str, ...] = ("ppl", "article_tier", "article_cat_2")
    log_cols: tuple[str, ...] = (
        "product_order_amt", "avg_sell_price", "avg_purchase_price", "avg_high_temp",
        "total_order_amt", "nr_articles_in_cat", "nr_articles_in_cat_2",
        "product_order_amt_t_1", "product_order_amt_t_2",
        "avg_sell_price_t_1", "avg_sell_price_t_2", "week_nr", "avg_unavailability_perc")
    week_origin: date = date(1995, 1, 2)   # first Monday of the panel
    drop_zero_demand: bool = True
    outlier_weeks: tuple[date, ...] = field(default_factory=tuple)
    # price-line x regime dummies (pre_<line>, post_<line>) after this week start
    shift_date: date | None = date(1998, 6, 29)
    regime_lines: tuple[str, ...] = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    # per-column polynomial degrees on design columns, e.g. {"l_week_nr": 2}
    powers: tuple[tuple[str, int], ...] = (("l_week_nr", 2), ("avg_unavailability_perc", 2))
    # columns imputed into "<col>_m" with the max (or mean) of their valid values
    impute: tuple[tuple[str, str], ...] = (("l_product_order_amt_t_1", "max"),
                                            ("l_product_order_amt_t_2", "max"))
