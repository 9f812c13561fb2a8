"""Warehouse-shaped inputs derived from the driver's star-schema tables.

The panel operators are written against the warehouse tables of the
modelled workload (article, calendar, price list, order lines, orders,
promotions, warehouse counts, weather). This module builds each of them
as a lazy DataFrame over the driver tables, so every panel query reads
the whole given tables and its work grows with them.

Mapping (fixed; written again, independently, in SQL in ``plans.oracle_fixtures``):

article            part: key_article = p_partkey, level 1 = p_type, level 2 = p_brand
price line         order priority; '5-LOW' is the default line
order date         o_orderdate (key_date = YYYYMMDD, key_week = key of its Monday)
regular sales      l_quantity, 0 when l_discount >= 0.08 (promo quantity otherwise)
price list entry   per line item: round(100 * extendedprice / quantity) cents,
                   valid from l_shipdate to l_shipdate + 7 * l_linenumber days
promotion          line items with l_discount >= 0.08, same validity; promotion id
                   = discount in percent; deleted when l_returnflag = 'A'
warehouse counts   per line item on its ship date: unavailable 1 if 'R', 0 if 'A',
                   NULL if 'N'; ordered 1
weather            per order: temperature = o_totalprice / 9973, icon = o_orderstatus
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.functions.scalar import key_of_date, week_key
from demandlab.sources.io import Tables

# fixed values of the stand-in mapping
PROMO_DISCOUNT = 0.08          # discount at or above which a line is a promotion
ASSORTMENT_BASE = "1994-06-01"  # articles enter the assortment p_size weeks after this
REMOVED_FROM_SIZE = 48          # articles with p_size >= this left the assortment ...
REMOVED_ON = "2000-06-30"       # ... on this day
TEMPERATURE_DIVISOR = 9973.0    # weather temperature = o_totalprice / this


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                             "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")


def _valid_to(c_ship: str = "l_shipdate", c_line: str = "l_linenumber"):
    return F.timestamp_add("DAY", F.col(c_line) * 7, F.col(c_ship))


def dm_article(t: Tables) -> DataFrame:
    p = t.part
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("key_article"),
        F.concat(F.lit("A"), F.col("p_partkey").cast("string")).alias("article_id"),
        F.col("p_name").alias("art_supply_chain_name"),
        F.timestamp_add("DAY", size * 7, F.lit(ASSORTMENT_BASE).cast("timestamp_ntz"))
         .alias("art_in_store_date_last_added"),
        F.when(size >= REMOVED_FROM_SIZE, F.lit(REMOVED_ON).cast("timestamp_ntz"))
         .alias("art_in_store_date_last_removed"),
        F.col("p_type").alias("art_p_cat_lev_1"),
        F.col("p_brand").alias("art_p_cat_lev_2"),
        F.concat(F.lit("S"), (size / 10).cast("int").cast("string")).alias("art_p_cat_lev_3"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("art_p_cat_lev_4"),
        F.when(F.col("p_retailprice") < 930, "Good").when(F.col("p_retailprice") < 965, "Better")
         .otherwise("Best").alias("art_quality_tier"),
        size.cast("double").alias("art_content_volume"),
        F.when(size <= 5, "liter").when(size <= 45, "ml").alias("art_content_volume_uom"),
        F.when(size >= 30, "yes").when(size >= 3, "no").alias("art_is_multipack"),
    )


def dm_order(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("key_order"),
                           F.col("o_orderpriority").alias("order_price_line_type"))


def dm_date(t: Tables) -> DataFrame:
    """Gap-free calendar over the order-date span (one tiny aggregate + explode)."""
    span = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"),
                        F.max(F.to_date("o_orderdate")).alias("hi"))
    d = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return d.select(key_of_date("date").alias("key_date"), week_key("date").alias("key_week"), "date")


def ft_orderline(t: Tables) -> DataFrame:
    li = _lines(t)
    o = t.orders.select("o_orderkey", "o_orderdate")
    promo = F.col("l_discount") >= PROMO_DISCOUNT
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("key_article"),
        F.col("l_orderkey").alias("key_order"),
        key_of_date(F.to_date("o_orderdate")).alias("key_order_date"),
        F.when(promo, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("orig_regular_sales_qty"),
        F.when(promo, F.col("l_quantity")).otherwise(F.lit(0.0)).alias("orig_promo_qty"),
    )


def ft_price(t: Tables) -> DataFrame:
    li = _lines(t)
    o = t.orders.select("o_orderkey", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("key_article"),
        F.col("o_orderpriority").alias("price_line_type"),
        F.lit("list").alias("price_type"),
        F.round(F.try_divide(F.col("l_extendedprice") * 100, F.col("l_quantity"))).cast("long")
         .alias("price_in_cents"),
        F.col("l_shipdate").alias("price_start_date_time"),
        _valid_to().alias("price_end_date_time"),
    )


def ft_promotion_article_history(t: Tables) -> DataFrame:
    li = _lines(t).where(F.col("l_discount") >= PROMO_DISCOUNT)
    return li.select(
        F.round(F.col("l_discount") * 100).cast("long").alias("key_promotion"),
        F.col("l_partkey").alias("key_article"),
        F.col("l_shipdate").alias("promo_art_active_start_date"),
        _valid_to().alias("promo_art_active_end_date"),
        F.when(F.col("l_returnflag") == "A", "yes").otherwise("no").alias("promo_art_is_deleted"),
    )


def dm_promotion(t: Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_discount") >= PROMO_DISCOUNT)
    k = F.round(F.col("l_discount") * 100).cast("long")
    return li.select(k.alias("key_promotion")).distinct().select(
        "key_promotion",
        F.lit("discount").alias("promo_mechanism"),
        F.concat(F.col("key_promotion").cast("string"), F.lit(" pct")).alias("promo_name"))


def ft_warehouse_article_daily(t: Tables) -> DataFrame:
    rf = F.col("l_returnflag")
    return t.lineitem.select(
        key_of_date(F.to_date("l_shipdate")).alias("key_date"),
        F.col("l_partkey").alias("key_article"),
        F.when(rf == "R", F.lit(1)).when(rf == "A", F.lit(0)).cast("long")
         .alias("event_date_unavailable_deliveryline_count"),
        F.lit(1).cast("long").alias("order_date_orderline_count"),
    )


def dm_weather_daily(t: Tables) -> DataFrame:
    return t.orders.select(
        F.to_date("o_orderdate").alias("wthr_dly_date"),
        (F.col("o_totalprice") / TEMPERATURE_DIVISOR).alias("wthr_dly_temperature_high"),
        F.col("o_orderstatus").alias("wthr_dly_icon"),
    )


class Warehouse:
    """All warehouse-shaped inputs of one data folder."""

    def __init__(self, tables: Tables):
        self.t = tables

    @property
    def dm_article(self): return dm_article(self.t)
    @property
    def dm_order(self): return dm_order(self.t)
    @property
    def dm_date(self): return dm_date(self.t)
    @property
    def ft_orderline(self): return ft_orderline(self.t)
    @property
    def ft_price(self): return ft_price(self.t)
    @property
    def ft_promotion_article_history(self): return ft_promotion_article_history(self.t)
    @property
    def dm_promotion(self): return dm_promotion(self.t)
    @property
    def ft_warehouse_article_daily(self): return ft_warehouse_article_daily(self.t)
    @property
    def dm_weather_daily(self): return dm_weather_daily(self.t)


# ---------------------------------------------------------------- regression panel
# (brand, type, week, priority) cells: y = ln sum quantity, d = ln avg unit price,
# z = ln avg extended price (instrument), x = avg discount; fold and split from
# integer arithmetic on the cell key, so other engines reproduce them exactly.
FOLD_ORIGIN = "1990-01-01"


def regression_panel(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    week = F.to_date(F.date_trunc("week", F.col("o_orderdate")))
    g = j.groupBy("p_brand", "p_type", week.alias("week"), F.col("o_orderpriority").alias("ppl")).agg(
        F.sum("l_quantity").alias("qty"),
        F.avg(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))).alias("unit_price"),
        F.avg("l_extendedprice").alias("ext_price"),
        F.avg("l_discount").alias("x"),
        F.min("p_size").alias("min_size"),
        F.count(F.lit(1)).alias("n_lines"))
    weeks = (F.datediff(F.col("week"), F.lit(FOLD_ORIGIN).cast("date")) / 7).cast("long")
    from demandlab.functions.scalar import ln_pos
    from demandlab.operators import sampling
    bucket = F.col("_bucket")
    panel = g.select(
        "p_brand", "p_type", "week", "ppl",
        ln_pos("qty").alias("y"), ln_pos("unit_price").alias("d"), ln_pos("ext_price").alias("z"),
        "x", F.lit(1.0).alias("const"), F.col("n_lines").cast("double").alias("n_lines"),
        (weeks * 31 + F.col("min_size") * 17).alias("_bucket"))
    tagged = sampling.with_fold(panel, fold=F.pmod(bucket, F.lit(5)))
    tagged = sampling.split(tagged, test_pct=20, bucket=F.pmod(bucket + F.lit(13), F.lit(100)))
    return tagged.drop("_bucket")
