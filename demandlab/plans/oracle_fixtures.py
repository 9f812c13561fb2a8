"""DuckDB text of the warehouse stand-ins (same mapping as ``sources.fixtures``),
written independently in SQL so the oracle does not share code with Spark."""

from __future__ import annotations

from demandlab.config import PanelConfig, date_key
from demandlab.sources import fixtures as fx


def _key(expr: str) -> str:
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) AS INTEGER)"


def warehouse_ctes() -> str:
    promo = f"CAST({fx.PROMO_DISCOUNT} AS DOUBLE)"
    return f"""
dm_article AS (
  SELECT p_partkey AS key_article,
         'A' || CAST(p_partkey AS VARCHAR) AS article_id,
         p_name AS art_supply_chain_name,
         TIMESTAMP '{fx.ASSORTMENT_BASE}' + to_days(CAST(p_size * 7 AS INTEGER)) AS art_in_store_date_last_added,
         CASE WHEN p_size >= {fx.REMOVED_FROM_SIZE} THEN TIMESTAMP '{fx.REMOVED_ON}' END AS art_in_store_date_last_removed,
         p_type AS art_p_cat_lev_1,
         p_brand AS art_p_cat_lev_2,
         'S' || CAST(p_size // 10 AS VARCHAR) AS art_p_cat_lev_3,
         split_part(p_name, ' ', 1) AS art_p_cat_lev_4,
         CASE WHEN p_retailprice < 930 THEN 'Good' WHEN p_retailprice < 965 THEN 'Better' ELSE 'Best' END AS art_quality_tier,
         CAST(p_size AS DOUBLE) AS art_content_volume,
         CASE WHEN p_size <= 5 THEN 'liter' WHEN p_size <= 45 THEN 'ml' END AS art_content_volume_uom,
         CASE WHEN p_size >= 30 THEN 'yes' WHEN p_size >= 3 THEN 'no' END AS art_is_multipack
  FROM part),
dm_order AS (SELECT o_orderkey AS key_order, o_orderpriority AS order_price_line_type FROM orders),
dm_date AS (
  SELECT {_key('d')} AS key_date, {_key("date_trunc('week', d)")} AS key_week, d AS date
  FROM (SELECT CAST(g.generate_series AS DATE) AS d
        FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) s,
             generate_series(s.lo, s.hi, INTERVAL 1 DAY) g)),
ft_orderline AS (
  SELECT l_partkey AS key_article, l_orderkey AS key_order,
         {_key('o_orderdate')} AS key_order_date,
         CASE WHEN l_discount >= {promo} THEN 0.0 ELSE l_quantity END AS orig_regular_sales_qty,
         CASE WHEN l_discount >= {promo} THEN l_quantity ELSE 0.0 END AS orig_promo_qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ft_price AS (
  SELECT l_partkey AS key_article, o_orderpriority AS price_line_type, 'list' AS price_type,
         CAST(round(l_extendedprice * 100 / NULLIF(l_quantity, 0)) AS BIGINT) AS price_in_cents,
         l_shipdate AS price_start_date_time,
         l_shipdate + to_days(CAST(7 * l_linenumber AS INTEGER)) AS price_end_date_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ft_promotion_article_history AS (
  SELECT CAST(round(l_discount * 100) AS BIGINT) AS key_promotion, l_partkey AS key_article,
         l_shipdate AS promo_art_active_start_date,
         l_shipdate + to_days(CAST(7 * l_linenumber AS INTEGER)) AS promo_art_active_end_date,
         CASE WHEN l_returnflag = 'A' THEN 'yes' ELSE 'no' END AS promo_art_is_deleted
  FROM lineitem WHERE l_discount >= {promo}),
dm_promotion AS (
  SELECT key_promotion, 'discount' AS promo_mechanism, CAST(key_promotion AS VARCHAR) || ' pct' AS promo_name
  FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS key_promotion FROM lineitem WHERE l_discount >= {promo})),
ft_warehouse_article_daily AS (
  SELECT {_key('l_shipdate')} AS key_date, l_partkey AS key_article,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 END AS BIGINT) AS event_date_unavailable_deliveryline_count,
         CAST(1 AS BIGINT) AS order_date_orderline_count
  FROM lineitem),
dm_weather_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS wthr_dly_date, o_totalprice / {fx.TEMPERATURE_DIVISOR} AS wthr_dly_temperature_high,
         o_orderstatus AS wthr_dly_icon
  FROM orders)"""


def panel_ctes(cfg: PanelConfig) -> str:
    """Panel CTEs written independently of the Spark code, straight from the
    semantics: a full article x day x line grid, validity intervals joined with a
    BETWEEN condition, latest entry by window rank, outer joins to the grid."""
    s, e = cfg.start_key, cfg.end_key
    shift = date_key(cfg.shift_date)
    lines = ", ".join(f"'{x}'" for x in cfg.regime_lines)
    dflt = cfg.default_line
    return f"""
assort AS (
  SELECT DISTINCT key_article FROM dm_article
  WHERE art_p_cat_lev_1 = '{cfg.category}'
    AND CAST(art_in_store_date_last_added AS DATE) <= DATE '{cfg.in_assortment_from}'
    AND coalesce(CAST(art_in_store_date_last_removed AS DATE) > DATE '{cfg.in_assortment_to}', true)),
period_cal AS (SELECT key_date, key_week, date FROM dm_date WHERE key_date >= {s} AND key_date <= {e}),
line_levels AS (SELECT price_line_type AS ppl FROM ft_price WHERE price_line_type IS NOT NULL GROUP BY 1),
grid AS (SELECT a.key_article, c.key_date, c.key_week, c.date, l.ppl FROM assort a, period_cal c, line_levels l),
ol_in_period AS (
  SELECT o.key_article, o.key_order, o.key_order_date AS day_key, r.order_price_line_type AS line,
         o.orig_regular_sales_qty AS qty, o.orig_promo_qty AS promo_qty
  FROM ft_orderline o JOIN dm_order r ON r.key_order = o.key_order
  WHERE o.key_order_date >= {s} AND o.key_order_date <= {e}),
day_line_totals AS (
  SELECT day_key, line, count(DISTINCT key_order) AS n_orders, sum(qty) AS regular_qty, sum(promo_qty) AS promo_qty
  FROM ol_in_period GROUP BY 1, 2),
article_day_line AS (SELECT key_article, day_key, line, sum(qty) AS qty FROM ol_in_period GROUP BY 1, 2, 3),
order_rate AS (
  SELECT x.key_article, x.day_key AS key_order_date, x.line AS ppl, t.n_orders AS nr_orders_day_ppl,
         CASE WHEN x.qty > 0 THEN x.qty ELSE 0.0 END AS sum_regular_art_sales_ppl,
         CASE WHEN t.n_orders = 0 THEN 0.0 ELSE (CASE WHEN x.qty > 0 THEN x.qty ELSE 0.0 END) / t.n_orders END AS aor
  FROM article_day_line x RIGHT JOIN day_line_totals t ON x.day_key = t.day_key AND x.line = t.line),
price_valid AS (
  SELECT key_article, price_line_type, price_in_cents, price_start_date_time AS t0, price_end_date_time AS t1,
         CAST(price_start_date_time AS DATE) AS d0, CAST(price_end_date_time AS DATE) AS d1
  FROM ft_price WHERE price_type = '{cfg.price_type}'),
line_price_rows AS (
  SELECT g.*, CASE WHEN g.ppl = '{dflt}' THEN NULL ELSE v.price_in_cents END AS price_in_cents_ppl,
         CASE WHEN g.ppl = '{dflt}' THEN v.price_in_cents END AS price_in_cents_default
  FROM grid g LEFT JOIN price_valid v
    ON v.key_article = g.key_article AND v.price_line_type = g.ppl AND g.date BETWEEN v.d0 AND v.d1
  QUALIFY row_number() OVER (PARTITION BY g.key_article, g.key_date, g.ppl
                             ORDER BY v.t1 DESC, v.t0 DESC, v.price_in_cents DESC) = 1),
default_price_rows AS (
  SELECT g.*, v.price_in_cents AS price_in_cents_default
  FROM grid g LEFT JOIN price_valid v
    ON v.key_article = g.key_article AND v.price_line_type = '{dflt}' AND g.date BETWEEN v.d0 AND v.d1
  QUALIFY row_number() OVER (PARTITION BY g.key_article, g.key_date, g.ppl
                             ORDER BY v.t1 DESC, v.t0 DESC, v.price_in_cents DESC) = 1),
promo_rows AS (
  SELECT h.key_article, c.key_date, pm.promo_mechanism || '/' || pm.promo_name AS promo_metadata
  FROM ft_promotion_article_history h
    JOIN dm_promotion pm ON pm.key_promotion = h.key_promotion
    JOIN dm_article art ON art.key_article = h.key_article
    JOIN dm_date c ON c.date BETWEEN CAST(h.promo_art_active_start_date AS DATE) AND CAST(h.promo_art_active_end_date AS DATE)
  WHERE h.promo_art_is_deleted = 'no' AND art.art_p_cat_lev_1 = '{cfg.category}'
    AND c.key_date >= {s} AND c.key_date <= {e}),
unavail AS (
  SELECT w.key_date, w.key_article,
         sum(w.event_date_unavailable_deliveryline_count)
           / NULLIF(sum(w.order_date_orderline_count) + sum(w.event_date_unavailable_deliveryline_count), 0)
           AS unavailability_perc
  FROM ft_warehouse_article_daily w
  WHERE w.key_date IN (SELECT key_date FROM period_cal)
    AND w.key_article IN (SELECT key_article FROM dm_article WHERE art_p_cat_lev_1 = '{cfg.category}')
  GROUP BY 1, 2),
wx_rows AS (
  SELECT c.key_date, x.wthr_dly_temperature_high AS temp, x.wthr_dly_icon AS icon
  FROM dm_weather_daily x JOIN period_cal c ON x.wthr_dly_date = c.date),
wx_mode AS (
  SELECT key_date, icon FROM (SELECT key_date, icon, count(*) AS k FROM wx_rows WHERE icon IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY key_date ORDER BY k DESC, icon) = 1),
wx AS (
  SELECT t.key_date, t.avg_high_temp, m.icon AS weather_type
  FROM (SELECT key_date, avg(temp) AS avg_high_temp FROM wx_rows GROUP BY 1) t
  LEFT JOIN wx_mode m ON m.key_date = t.key_date),
promo_flag AS (SELECT DISTINCT key_article, key_date FROM promo_rows),
daily AS (
  SELECT g.key_article, g.key_date, g.date, art.art_supply_chain_name AS article_name, g.ppl,
         CASE WHEN g.key_date > {shift} THEN 'post' ELSE 'pre' END AS shift,
         CASE WHEN g.key_date <= {shift} THEN g.ppl WHEN g.ppl IN ({lines}) THEN 'post' || g.ppl END AS ppln,
         r.aor,
         coalesce(lp.price_in_cents_ppl, dp.price_in_cents_default) AS price_in_cents,
         CAST(pf.key_article IS NOT NULL AS INTEGER) AS promo_dummy,
         u.unavailability_perc, wx.avg_high_temp, wx.weather_type,
         art.art_quality_tier AS article_tier, art.art_p_cat_lev_2 AS article_cat_2,
         art.art_p_cat_lev_3 AS article_cat_3, art.art_p_cat_lev_4 AS article_cat_4,
         r.nr_orders_day_ppl, r.sum_regular_art_sales_ppl, g.key_week, art.article_id,
         art.art_p_cat_lev_1 AS article_cat_1,
         art.art_content_volume * CASE art.art_content_volume_uom WHEN 'ml' THEN 1 WHEN 'liter' THEN 1000 END
           AS art_content_volume,
         CASE art.art_is_multipack WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS art_is_multipack,
         dp.price_in_cents_default
  FROM grid g
    LEFT JOIN dm_article art ON art.key_article = g.key_article
    LEFT JOIN order_rate r ON r.key_article = g.key_article AND r.key_order_date = g.key_date AND r.ppl = g.ppl
    LEFT JOIN line_price_rows lp ON lp.key_article = g.key_article AND lp.date = g.date AND lp.ppl = g.ppl
    LEFT JOIN default_price_rows dp ON dp.key_article = g.key_article AND dp.date = g.date AND dp.ppl = g.ppl
    LEFT JOIN promo_flag pf ON pf.key_article = g.key_article AND pf.key_date = g.key_date
    LEFT JOIN unavail u ON u.key_article = g.key_article AND u.key_date = g.key_date
    LEFT JOIN wx ON wx.key_date = g.key_date
  WHERE g.ppl <> '{dflt}')"""


def regression_cte() -> str:
    return f"""
reg AS (
  SELECT p_brand, p_type, week, ppl,
         CASE WHEN qty > 0 THEN ln(qty) END AS y,
         CASE WHEN unit_price > 0 THEN ln(unit_price) END AS d,
         CASE WHEN ext_price > 0 THEN ln(ext_price) END AS z,
         x, CAST(1.0 AS DOUBLE) AS const, CAST(n_lines AS DOUBLE) AS n_lines,
         CAST(((date_diff('day', DATE '{fx.FOLD_ORIGIN}', week) // 7) * 31 + min_size * 17) % 5 AS INTEGER) AS fold,
         CAST(((date_diff('day', DATE '{fx.FOLD_ORIGIN}', week) // 7) * 31 + min_size * 17 + 13) % 100 < 20 AS INTEGER) AS is_test
  FROM (SELECT p_brand, p_type, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, o_orderpriority AS ppl,
               sum(l_quantity) AS qty, avg(l_extendedprice / NULLIF(l_quantity, 0)) AS unit_price,
               avg(l_extendedprice) AS ext_price, avg(l_discount) AS x, min(p_size) AS min_size,
               count(*) AS n_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL))"""
