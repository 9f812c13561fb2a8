"""Named queries (Spark) and their DuckDB oracles over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from demandlab.config import PanelConfig
from demandlab.operators import panel as P
from demandlab.plans.oracle_fixtures import panel_ctes, warehouse_ctes
from demandlab.plans.panel_plan import warehouse

CFG = PanelConfig()
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (float sums depend on summation order). Whole numbers are
    their own rounding and skip the decimal arithmetic of ``round``."""
    def short(f):
        c = F.col(f.name)
        r = F.round(c, digits)
        return (F.when(c == F.rint(c), c + F.lit(0.0)).otherwise(r) if isinstance(f.dataType, DoubleType) else r).alias(f.name)
    return df.select(*[short(f) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name) for f in df.schema.fields])


def sql_rounded(select_sql: str, double_cols: list[str], digits: int = DIGITS) -> str:
    if not double_cols:
        return select_sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({select_sql}) q"


def with_panel(body: str, cfg: PanelConfig = CFG) -> str:
    return f"WITH {warehouse_ctes()},{panel_ctes(cfg)}\n{body}"


# ------------------------------------------------------------------ panel

def _skel(wh):
    lines = P.price_lines(wh.ft_price, CFG)
    n = P.dense_partitions(wh.dm_article, CFG, len(lines))
    return P.skeleton(wh.dm_article, wh.dm_date, lines, CFG, n), n


def q_skeleton(spark: SparkSession, d: str) -> DataFrame:
    return _skel(warehouse(spark, d))[0]


def q_orders_per_line(spark, d):
    wh = warehouse(spark, d)
    return P.orders_per_line(wh.ft_orderline, wh.dm_order, CFG)


def q_aor(spark, d):
    wh = warehouse(spark, d)
    return P.aor(wh.ft_orderline, wh.dm_order, CFG, len(P.price_lines(wh.ft_price, CFG)))


def q_prices(spark, d):
    wh = warehouse(spark, d)
    sk, n = _skel(wh)
    return P.prices(sk, wh.ft_price, CFG, P.select_articles(wh.dm_article, CFG), n)


def q_default_prices(spark, d):
    wh = warehouse(spark, d)
    sk, n = _skel(wh)
    return P.default_prices(sk, wh.ft_price, CFG, P.select_articles(wh.dm_article, CFG), n)


def q_promo_days(spark, d):
    wh = warehouse(spark, d)
    return P.promo_days(wh.ft_promotion_article_history, wh.dm_promotion, wh.dm_article, wh.dm_date, CFG)


def q_unavailability(spark, d):
    wh = warehouse(spark, d)
    return P.unavailability(wh.ft_warehouse_article_daily, wh.dm_article, wh.dm_date, CFG)


def q_weather(spark, d):
    wh = warehouse(spark, d)
    return rounded(P.weather(wh.dm_weather_daily, wh.dm_date, CFG))


def q_daily_features(spark, d):
    return P.daily_features(warehouse(spark, d), CFG, digits=DIGITS)


def q_weekly(spark, d):
    return rounded(P.weekly(P.daily_features(warehouse(spark, d), CFG, packed=True), CFG))


WEEKLY_SQL = """
SELECT w.key_article, w.key_week, w.ppl, w.product_order_amt, w.total_order_amt, w.avg_sell_price,
       w.avg_purchase_price, w.avg_unavailability_perc, w.avg_high_temp,
       CAST(coalesce(n1.n, 0) AS BIGINT) AS nr_articles_in_cat,
       CAST(coalesce(n2.n, 0) AS BIGINT) AS nr_articles_in_cat_2,
       CAST(isoyear(w.ws) * 100 + week(w.ws) AS INTEGER) AS year_calendar_week,
       w.ws AS week_start_date, w.article_name, w.promo_dummy, w.article_tier, w.article_cat_1,
       w.article_cat_2, w.article_cat_3, w.article_cat_4, w.article_id, w.art_content_volume,
       w.art_is_multipack
FROM (SELECT key_article, key_week, ppl,
             sum(sum_regular_art_sales_ppl) AS product_order_amt,
             CAST(sum(nr_orders_day_ppl) AS BIGINT) AS total_order_amt,
             avg(price_in_cents) AS avg_sell_price,
             avg(price_in_cents_default) AS avg_purchase_price,
             avg(unavailability_perc) AS avg_unavailability_perc,
             avg(avg_high_temp) AS avg_high_temp,
             max(promo_dummy) AS promo_dummy,
             CAST(date_trunc('week', min(date)) AS DATE) AS ws,
             max(article_name) AS article_name, max(article_tier) AS article_tier,
             max(article_cat_1) AS article_cat_1, max(article_cat_2) AS article_cat_2,
             max(article_cat_3) AS article_cat_3, max(article_cat_4) AS article_cat_4,
             max(article_id) AS article_id, max(art_content_volume) AS art_content_volume,
             max(art_is_multipack) AS art_is_multipack
      FROM daily GROUP BY key_article, key_week, ppl) w
LEFT JOIN (SELECT key_week, article_cat_1, count(DISTINCT key_article) AS n FROM daily
           WHERE price_in_cents IS NOT NULL GROUP BY ALL) n1
  ON w.key_week = n1.key_week AND w.article_cat_1 = n1.article_cat_1
LEFT JOIN (SELECT key_week, article_cat_2, count(DISTINCT key_article) AS n FROM daily
           WHERE price_in_cents IS NOT NULL GROUP BY ALL) n2
  ON w.key_week = n2.key_week AND w.article_cat_2 = n2.article_cat_2"""


def _panel_sql() -> dict[str, str]:
    return {
        "skeleton": with_panel("SELECT * FROM grid"),
        "orders_per_line": with_panel(
            "SELECT day_key AS key_order_date, line AS order_price_line_type, n_orders AS nr_orders_day_ppl, "
            "regular_qty AS sum_regular_sales, promo_qty AS sum_promo_sales FROM day_line_totals"),
        "aor": with_panel("SELECT * FROM order_rate"),
        "prices": with_panel("SELECT * FROM line_price_rows"),
        "default_prices": with_panel("SELECT * FROM default_price_rows"),
        "promo_days": with_panel("SELECT * FROM promo_rows"),
        "unavailability": with_panel("SELECT * FROM unavail"),
        "weather": with_panel(sql_rounded("SELECT * FROM wx", ["avg_high_temp"])),
        "daily_features": with_panel(sql_rounded(
            "SELECT * FROM daily",
            ["aor", "unavailability_perc", "avg_high_temp", "sum_regular_art_sales_ppl",
             "art_content_volume"])),
        "weekly": with_panel(sql_rounded(
            WEEKLY_SQL, ["product_order_amt", "avg_sell_price", "avg_purchase_price",
                         "avg_unavailability_perc", "avg_high_temp", "art_content_volume"])),
    }


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "skeleton": q_skeleton,
    "orders_per_line": q_orders_per_line,
    "aor": q_aor,
    "prices": q_prices,
    "default_prices": q_default_prices,
    "promo_days": q_promo_days,
    "unavailability": q_unavailability,
    "weather": q_weather,
    "daily_features": q_daily_features,
    "weekly": q_weekly,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from demandlab.plans import registry_design, registry_learners, registry_models
    out = dict(QUERIES)
    out.update(registry_models.QUERIES)
    out.update(registry_learners.QUERIES)
    out.update(registry_design.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from demandlab.plans import registry_design, registry_models
    out = {}
    out.update(_panel_sql())
    out.update(registry_models.oracle_sql())
    out.update(registry_design.ORACLE_SQL)
    return {k: v for k, v in out.items() if k in queries()}
