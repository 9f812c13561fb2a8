"""Daily and weekly panel operators (skeleton, order rate, price in force,
promotion days, unavailability, weather, daily feature table, weekly roll-up).

Plan shape (see README "Panel plan"):

* Dense side. The skeleton (article x day x price line) is generated, not
  joined: the article list is hash-partitioned by ``key_article`` and every
  article row inlines the calendar (an array bounded by the configured period)
  and explodes its lines (a checked, small level list); article attributes ride along.
* Sparse side. Order rates and line prices live on (article, day, line),
  promotion flags, unavailability and default prices on (article, day).
* They are combined with union + aggregate (no outer-join chains) into one row per
  article, partitioned by ``key_article`` like the dense side: spans of prices and
  promotions, days of order rates and unavailability. Articles and facts join on
  ``key_article`` alone; each line's spans then become arrays by day, and the calendar
  (with the weather, an array too) is exploded against them: no dense row is joined
  or shuffled, whatever ``spark.sql.requireAllClusterKeysForCoPartition`` says.
  Prices reach the skeleton the same way, as one row per article with the prices by day.
* Validity intervals (prices, promotions) are swept: at most one candidate per
  start day is left by an aggregate with map-side combine, a window over
  these finds the disjoint spans that count, and only those become days. No
  range-condition join, and no row that isn't an output day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.config import PanelConfig
from demandlab.functions.scalar import (clamp_positive, div0, key_of_date, presence_flag,
                                        regime_line, safe_div, volume_ml, yes_no_flag)

# largest broadcast side, in rows, when the bound is proven from the configuration
BROADCAST_ROW_LIMIT = 2_000_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# target rows per task on the dense (article x day x line) side
DENSE_ROWS_PER_PARTITION = 1_000_000


def dense_partitions(dm_article: DataFrame, cfg: PanelConfig, n_lines: int) -> int:
    """Partition count for the generated panel, sized by its row count:
    assortment articles (one count over the article dimension) x period days
    x lines / ``DENSE_ROWS_PER_PARTITION``, at least ``spark.sql.shuffle.partitions``.
    The dense side and every sparse side joined to it use this same count."""
    n_art = select_articles(dm_article, cfg).count()
    rows = n_art * cfg.period_days * max(n_lines, 1)
    return max(_partitions(dm_article), -(-rows // DENSE_ROWS_PER_PARTITION))


def _bounded_broadcast(df: DataFrame, bound_rows: int) -> DataFrame:
    """Broadcast only when a proven upper bound on the rows is small; else leave
    the choice to the planner / AQE (which re-plans on measured sizes)."""
    return F.broadcast(df) if bound_rows <= BROADCAST_ROW_LIMIT else df


# ---------------------------------------------------------------- dimensions

def assortment(dm_article: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Articles of the category still in the assortment.

    added::DATE <= from AND (removed::DATE > to OR removed IS NULL) AND level 1 = category
    """
    added = F.to_date("art_in_store_date_last_added")
    removed = F.to_date("art_in_store_date_last_removed")
    return dm_article.where(
        (added <= F.lit(cfg.in_assortment_from))
        & ((removed > F.lit(cfg.in_assortment_to)) | F.col("art_in_store_date_last_removed").isNull())
        & (F.col("art_p_cat_lev_1") == F.lit(cfg.category)))


def select_articles(dm_article: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Distinct article keys of the assortment (A1)."""
    return assortment(dm_article, cfg).select("key_article").distinct()


def article_attributes(dm_article: DataFrame) -> DataFrame:
    """Renamed and normalised article attributes of the daily table."""
    return dm_article.select(
        "key_article",
        F.col("art_supply_chain_name").alias("article_name"),
        F.col("art_quality_tier").alias("article_tier"),
        F.col("art_p_cat_lev_1").alias("article_cat_1"),
        F.col("art_p_cat_lev_2").alias("article_cat_2"),
        F.col("art_p_cat_lev_3").alias("article_cat_3"),
        F.col("art_p_cat_lev_4").alias("article_cat_4"),
        "article_id",
        volume_ml("art_content_volume", "art_content_volume_uom").alias("art_content_volume"),
        yes_no_flag("art_is_multipack").alias("art_is_multipack"),
    )


def period_dates(dm_date: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Calendar rows of the period (P4). At most ``cfg.period_days`` rows."""
    return (dm_date.where(F.col("key_date").between(cfg.start_key, cfg.end_key))
            .select("key_date", "key_week", "date"))


def price_lines(ft_price: DataFrame, cfg: PanelConfig) -> list[str]:
    """Distinct price lines (A1) as a level list, size-checked against ``cfg.max_lines``."""
    rows = (ft_price.select(F.col("price_line_type").alias("ppl")).distinct()
            .where(F.col("ppl").isNotNull()).limit(cfg.max_lines + 1).collect())
    if len(rows) > cfg.max_lines:
        raise ValueError(f"more than {cfg.max_lines} price lines; raise PanelConfig.max_lines")
    return sorted(r.ppl for r in rows)


def _days_of(articles: DataFrame, cfg: PanelConfig, calendar: DataFrame) -> DataFrame:
    """Article rows x calendar days of the period, generated per article.

    The calendar, bounded by the period, is read once as an array (a scalar subquery)
    that each article row inlines: no lookup and no date arithmetic per generated row.
    """
    in_period = F.col("date").between(F.lit(cfg.start), F.lit(cfg.end))
    days = calendar.where(in_period).agg(F.collect_list(F.struct("key_date", "key_week", "date")))
    gen = articles.select("*", days.scalar().alias("days"))
    return gen.select(*articles.columns, F.inline("days"))


def skeleton(dm_article: DataFrame, dm_date: DataFrame, lines: list[str],
             cfg: PanelConfig, partitions: int | None = None) -> DataFrame:
    """Gap-free panel index: assortment articles x period days x price lines.

    Columns: key_article, key_date, key_week, date, ppl.

    The articles are dealt out before they are made distinct: a repartition that
    only repeats the aggregate's own shuffle would be dropped from the plan, and
    the article list, small in bytes, be coalesced into one task for all rows.
    """
    n = partitions or _partitions(dm_article)
    arts = assortment(dm_article, cfg).select("key_article").repartition(n, "key_article").distinct()
    ad = _days_of(arts, cfg, period_dates(dm_date, cfg))
    ppl = F.explode(F.array(*[F.lit(x) for x in lines])).alias("ppl")
    return ad.select("key_article", "key_date", "key_week", "date", ppl)


# ---------------------------------------------------------------- order rate

def orders_per_line(ft_orderline: DataFrame, dm_order: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Distinct orders and regular / promo sums per (day, line) in the period (A2)."""
    j = _orderlines_in_period(ft_orderline, dm_order, cfg)
    return j.groupBy("key_order_date", "order_price_line_type").agg(
        F.count_distinct("key_order").alias("nr_orders_day_ppl"),
        F.sum("orig_regular_sales_qty").alias("sum_regular_sales"),
        F.sum("orig_promo_qty").alias("sum_promo_sales"))


def _orderlines_in_period(ft_orderline: DataFrame, dm_order: DataFrame, cfg: PanelConfig) -> DataFrame:
    ol = ft_orderline.where(F.col("key_order_date").between(cfg.start_key, cfg.end_key))
    return ol.join(dm_order, "key_order")


def aor(ft_orderline: DataFrame, dm_order: DataFrame, cfg: PanelConfig,
        n_lines: int | None = None, articles: DataFrame | None = None) -> DataFrame:
    """Article order rate per (article, day, line).

    sum_regular_art_sales_ppl = IFF(SUM(regular) > 0, SUM(regular), 0)
    aor = DIV0(sum_regular_art_sales_ppl, distinct orders of that day and line)

    The right join of detail to its own (day, line) totals is rewritten as an
    inner join plus the totals rows that cannot match (NULL day or line): every
    other totals row has detail rows by construction. The totals side holds at
    most period days x (lines + 1) rows and is broadcast when that bound is small.
    Detail is aggregated before the join (map-side combine takes hot keys).
    ``articles`` (key_article) restricts the detail rows only: the totals always
    count every order of the day and line.
    """
    j = _orderlines_in_period(ft_orderline, dm_order, cfg)
    totals = j.groupBy("key_order_date", "order_price_line_type").agg(
        F.count_distinct("key_order").alias("nr_orders_day_ppl"))
    dj = j.join(articles, "key_article", "left_semi") if articles is not None else j
    detail = dj.groupBy("key_article", "key_order_date", "order_price_line_type").agg(
        F.sum("orig_regular_sales_qty").alias("_s"))
    bound = cfg.period_days * ((n_lines if n_lines is not None else cfg.max_lines) + 1)
    matched = detail.join(_bounded_broadcast(totals, bound),
                          ["key_order_date", "order_price_line_type"])
    unmatched = (totals.where(F.col("key_order_date").isNull() | F.col("order_price_line_type").isNull())
                 .select(F.lit(None).cast("long").alias("key_article"),
                         F.lit(None).cast("int").alias("key_order_date"),
                         F.lit(None).cast("string").alias("order_price_line_type"),
                         "nr_orders_day_ppl", F.lit(None).cast("double").alias("_s")))
    both = matched.select("key_article", "key_order_date", "order_price_line_type",
                          "nr_orders_day_ppl", "_s").unionByName(unmatched)
    s = clamp_positive("_s")
    return both.select(
        "key_article", "key_order_date", F.col("order_price_line_type").alias("ppl"),
        "nr_orders_day_ppl",
        s.alias("sum_regular_art_sales_ppl"),
        div0(s, F.col("nr_orders_day_ppl")).alias("aor"))


# ---------------------------------------------------------------- intervals

def _clamped(start: Column, end: Column, cfg: PanelConfig) -> tuple[Column, Column]:
    """First and last day of an interval within the period (start::DATE <= day <= end::DATE)."""
    return F.greatest(F.to_date(start), F.lit(cfg.start)), F.least(F.to_date(end), F.lit(cfg.end))


def _in_period(df: DataFrame, start: str, end: str, cfg: PanelConfig) -> DataFrame:
    """Interval rows with a day in the period; NULL bounds cover nothing."""
    lo, hi = _clamped(F.col(start), F.col(end), cfg)
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (lo <= hi))


def _days(spans: DataFrame, lo: str, hi: str) -> DataFrame:
    return spans.withColumn("date", F.explode(F.sequence(lo, hi))).drop(lo, hi)


def price_spans(ft_price: DataFrame, cfg: PanelConfig, articles: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Disjoint spans (key_article, ppl, price_in_cents, first_day, last_day) with one price in force each.

    The entry with the latest end time wins, ties by later start, then higher
    price. Of entries that start on the same day only the best can win anywhere, so an
    aggregate with map-side combine leaves at most one for each day of
    the period. Taken in order of priority, all earlier ones end no sooner: what
    they cover up to an entry's end reaches from their least start day on, so the
    entry is in force from its start to the day before that.
    """
    p = ft_price.where(F.col("price_type") == F.lit(cfg.price_type))
    if articles is not None:
        p = p.join(articles, "key_article", "left_semi")
    start, end = F.col("price_start_date_time"), F.col("price_end_date_time")
    best = F.max(F.struct(end.alias("e"), start.alias("s"), F.col("price_in_cents").alias("c")))
    first = (_in_period(p, "price_start_date_time", "price_end_date_time", cfg)
             .groupBy("key_article", F.col("price_line_type").alias("ppl"), _clamped(start, end, cfg)[0].alias("first_day")).agg(best.alias("b")))
    if partitions:
        first = first.repartition(partitions, "key_article")
    w = Window.partitionBy("key_article", "ppl").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    last = F.least(_clamped(F.col("b.s"), F.col("b.e"), cfg)[1], F.date_sub(F.min("first_day").over(w), 1))
    return (first.select("key_article", "ppl", F.col("b.c").alias("price_in_cents"), "first_day", last.alias("last_day"))
                 .where(F.col("first_day") <= F.col("last_day")))


def latest_price_per_day(ft_price: DataFrame, cfg: PanelConfig,
                         articles: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Price in force per (article, line, day): the entry with the latest end
    time, ties broken by later start, then higher price (W1, L2, decision D7).

    ``articles`` (key_article) drops other articles' entries first; with
    ``partitions`` the result is partitioned by ``key_article``.
    """
    return _days(price_spans(ft_price, cfg, articles, partitions), "first_day", "last_day")


def _by_day(spans: Column, cfg: PanelConfig, value) -> Column:
    """Disjoint spans (``first_day``, ``last_day``, ...) in order of time -> one array with the value
    of each day from ``cfg.start`` on, NULL between them (at most ``cfg.period_days`` entries)."""
    def stretch(x, i):
        since = F.when(i == 0, F.lit(cfg.start)).otherwise(F.date_add(F.get(spans, i - 1)["last_day"], 1))
        none = F.when(F.lit(False), value(x))
        return F.concat(F.array_repeat(none, F.datediff(x["first_day"], since)),
                        F.array_repeat(value(x), F.datediff(x["last_day"], x["first_day"]) + 1))

    return F.flatten(F.transform(spans, stretch))


def _prices_by_day(spans: DataFrame, cfg: PanelConfig, *by: str) -> DataFrame:
    """One row per ``by`` with ``by_day``: the price on each day from ``cfg.start`` on,
    up to the last priced day."""
    s = spans.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first_day", "last_day", "price_in_cents"))).alias("s"))
    return s.select(*by, _by_day(F.col("s"), cfg, lambda x: x["price_in_cents"]).alias("by_day"))


def _on_day(by_day: Column, cfg: PanelConfig) -> Column:
    return F.get(by_day, F.datediff(F.col("date"), F.lit(cfg.start)))


def prices(skel: DataFrame, ft_price: DataFrame, cfg: PanelConfig,
           articles: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Skeleton rows with the line price in force.

    price_in_cents_ppl = line price (NULL on the default line);
    price_in_cents_default = the default line's own price on default rows.

    The skeleton is joined on ``key_article`` alone, the key it is partitioned by,
    to one row per article (line -> prices by day), so it is never shuffled.
    """
    spans = price_spans(ft_price, cfg, articles, partitions or _partitions(ft_price))
    lines = _prices_by_day(spans.where(F.col("ppl").isNotNull()), cfg, "key_article", "ppl")
    lp = lines.groupBy("key_article").agg(F.map_from_entries(F.collect_list(F.struct("ppl", "by_day"))).alias("m"))
    j = skel.join(lp.hint("shuffle_hash"), "key_article", "left")
    price = _on_day(F.try_element_at(F.col("m"), F.col("ppl")), cfg)
    is_def = F.col("ppl") == F.lit(cfg.default_line)
    return j.select(
        *[F.col(c) for c in skel.columns],
        F.when(is_def, F.lit(None).cast("long")).otherwise(price).alias("price_in_cents_ppl"),
        F.when(is_def, price).otherwise(F.lit(None).cast("long")).alias("price_in_cents_default"))


def default_prices(skel: DataFrame, ft_price: DataFrame, cfg: PanelConfig,
                   articles: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Skeleton rows with the default line's price in force, whatever the row's line.
    Joined on ``key_article`` alone, like ``prices``."""
    own = ft_price.where(F.col("price_line_type") == F.lit(cfg.default_line))
    lp = _prices_by_day(price_spans(own, cfg, articles, partitions or _partitions(ft_price)), cfg, "key_article")
    return skel.join(lp.hint("shuffle_hash"), "key_article", "left").select(
        *[F.col(c) for c in skel.columns], _on_day(F.col("by_day"), cfg).alias("price_in_cents_default"))


# ---------------------------------------------------------------- daily facts

def promo_days(promo_hist: DataFrame, dm_promotion: DataFrame, dm_article: DataFrame,
               dm_date: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Promotion rows per covered day (J2, J7, F9, F10): key_article, key_date,
    promo_metadata = promo_mechanism || '/' || promo_name. Several promotions on
    one day give several rows, as in the source query."""
    h = promo_hist.where(F.col("promo_art_is_deleted") == "no")
    arts = select_articles_in_category(dm_article, cfg)
    h = h.join(arts, "key_article", "left_semi")
    start, end = "promo_art_active_start_date", "promo_art_active_end_date"
    lo, hi = _clamped(F.col(start), F.col(end), cfg)
    named = _in_period(h, start, end, cfg).join(dm_promotion, "key_promotion")
    days = _days(named.withColumns({"first_day": lo, "last_day": hi}), "first_day", "last_day")
    cal = _bounded_broadcast(period_dates(dm_date, cfg).select("date", "key_date"), cfg.period_days)
    j = days.join(cal, "date")
    return j.select("key_article", "key_date",
                    F.concat(F.col("promo_mechanism"), F.lit("/"), F.col("promo_name")).alias("promo_metadata"))


def promo_spans(promo_hist: DataFrame, dm_promotion: DataFrame, dm_article: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Disjoint spans (key_article, first_day, last_day) in which an article has any promotion.

    Overlapping intervals are merged before days are made: the longest interval
    for each start day (map-side combine), then a new span wherever an interval starts
    after the latest end so far.
    """
    start, end = "promo_art_active_start_date", "promo_art_active_end_date"
    h = promo_hist.where(F.col("promo_art_is_deleted") == "no").join(select_articles_in_category(dm_article, cfg), "key_article", "left_semi")
    h = h.join(dm_promotion.select("key_promotion"), "key_promotion", "left_semi")
    lo, hi = _clamped(F.col(start), F.col(end), cfg)
    longest = _in_period(h, start, end, cfg).groupBy("key_article", lo.alias("first_day")).agg(F.max(hi).alias("last_day"))
    so_far = Window.partitionBy("key_article").orderBy("first_day").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.date_add(F.max("last_day").over(so_far), 1)
    return longest.withColumn("first_day", F.greatest("first_day", covered)).where(F.col("first_day") <= F.col("last_day"))


def promo_flags(promo_hist: DataFrame, dm_promotion: DataFrame, dm_article: DataFrame,
                dm_date: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The days on which an article has any promotion: distinct (key_article, key_date)."""
    own = promo_spans(promo_hist, dm_promotion, dm_article, cfg)
    cal = _bounded_broadcast(period_dates(dm_date, cfg).select("date", "key_date"), cfg.period_days)
    return _days(own, "first_day", "last_day").join(cal, "date").select("key_article", "key_date")


def select_articles_in_category(dm_article: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Article keys of the category level 1 (no assortment window)."""
    return dm_article.where(F.col("art_p_cat_lev_1") == F.lit(cfg.category)).select("key_article")


def unavailability(wh_daily: DataFrame, dm_article: DataFrame, dm_date: DataFrame,
                   cfg: PanelConfig) -> DataFrame:
    """unavailable / (ordered + unavailable) per (day, article), each summed separately (A5).

    A NULL sum makes the ratio NULL; a zero denominator gives NULL.
    """
    cal = _bounded_broadcast(period_dates(dm_date, cfg).select("key_date"), cfg.period_days)
    arts = select_articles_in_category(dm_article, cfg)
    w = wh_daily.join(cal, "key_date").join(arts, "key_article", "left_semi")
    u = F.sum("event_date_unavailable_deliveryline_count")
    o = F.sum("order_date_orderline_count")
    return w.groupBy("key_date", "key_article").agg(safe_div(u, o + u).alias("unavailability_perc"))


def weather(weather_daily: DataFrame, dm_date: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Average high temperature and most frequent icon per day.

    Mode ties resolve to the smallest icon (deterministic).
    """
    cal = _bounded_broadcast(period_dates(dm_date, cfg).select("key_date", "date"), cfg.period_days)
    w = weather_daily.join(cal, weather_daily.wthr_dly_date == cal.date)
    return w.groupBy("key_date").agg(
        F.avg("wthr_dly_temperature_high").alias("avg_high_temp"),
        F.mode("wthr_dly_icon", True).alias("weather_type"))


# ---------------------------------------------------------------- daily table

DAILY_COLUMNS = [
    "key_article", "key_date", "date", "article_name", "ppl", "shift", "ppln", "aor",
    "price_in_cents", "promo_dummy", "unavailability_perc", "avg_high_temp", "weather_type",
    "article_tier", "article_cat_2", "article_cat_3", "article_cat_4", "nr_orders_day_ppl",
    "sum_regular_art_sales_ppl", "key_week", "article_id", "article_cat_1",
    "art_content_volume", "art_is_multipack", "price_in_cents_default",
]


def daily_features(wh, cfg: PanelConfig, lines: list[str] | None = None,
                   digits: int | None = None, packed: bool = False) -> DataFrame:
    """The wide daily feature table, one row per (article, day, non-default line).

    ``wh`` exposes the warehouse inputs (``sources.fixtures.Warehouse``).
    ``price_in_cents_default`` (the default line's price) is kept as an extra
    column: the weekly purchase-price stand-in is built from it.
    With ``digits`` doubles are rounded: once per fact, article and calendar day,
    not per row (each row only carries them). ``packed`` gives the article's
    attributes as one column ``PACKED``, for the roll-up.
    """
    lines = lines if lines is not None else price_lines(wh.ft_price, cfg)
    sell_lines = [x for x in lines if x != cfg.default_line]

    def own(c) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return c if digits is None else F.round(c, digits)

    # dense side: assortment articles with attributes, the calendar with its weather
    arts = assortment(wh.dm_article, cfg)
    attrs = article_attributes(arts).withColumn("art_content_volume", own("art_content_volume"))
    carried = [c for c in attrs.columns if c != "key_article"]
    if packed:
        carried = [PACKED, *[c for c in WEEKLY_ATTRS if c not in PACKED_ATTRS]]
        attrs = attrs.select("key_article", F.struct(*PACKED_ATTRS).alias(PACKED), *carried[1:])
    wx = _bounded_broadcast(weather(wh.dm_weather_daily, wh.dm_date, cfg), cfg.period_days)
    shift, _ = regime_line("key_date", F.lit(None), _shift_key(cfg), cfg.regime_lines)
    cal_w = (period_dates(wh.dm_date, cfg).where(F.col("date").between(F.lit(cfg.start), F.lit(cfg.end)))
             .join(wx, "key_date", "left"))
    day = F.struct("key_date", "key_week", "date", F.datediff("date", F.lit(cfg.start)).alias("_i"),
                   own("avg_high_temp").alias("avg_high_temp"), "weather_type", shift.alias("shift"))
    n = dense_partitions(wh.dm_article, cfg, len(sell_lines))

    # sparse side: order rates and unavailability of a day, spans of prices and promotions
    keys = arts.select("key_article")
    a = aor(wh.ft_orderline, wh.dm_order, cfg, len(lines), keys).where(F.col("key_article").isNotNull())
    cal_b = _bounded_broadcast(period_dates(wh.dm_date, cfg).select("key_date", "date"), cfg.period_days)
    a = a.join(cal_b, F.col("key_order_date") == F.col("key_date"))
    spans = price_spans(wh.ft_price, cfg, keys)
    promo = promo_spans(wh.ft_promotion_article_history, wh.dm_promotion, wh.dm_article, cfg)
    unav = unavailability(wh.ft_warehouse_article_daily, wh.dm_article, wh.dm_date, cfg).join(cal_b, "key_date")
    whole = (F.col("first_day"), F.col("last_day"))
    one_day = (F.col("date").alias("first_day"), F.col("date").alias("last_day"))
    sale = F.struct(own("aor").alias("aor"), "nr_orders_day_ppl", own("sum_regular_art_sales_ppl").alias("sum_regular_art_sales_ppl"))
    kinds = {"price": (spans, F.struct(*whole, F.col("price_in_cents").alias("v"))),
             "sale": (a, F.struct(*one_day, sale.alias("v"))),
             "promo": (promo.withColumn("ppl", F.lit(None).cast("string")), F.struct(*whole, F.lit(1).alias("v"))),
             "unav": (unav.withColumn("ppl", F.lit(None).cast("string")), F.struct(*one_day, own("unavailability_perc").alias("v")))}
    facts = None
    for kind, (df, entry) in kinds.items():
        rows = df.select("key_article", "ppl", entry.alias(kind))
        facts = rows if facts is None else facts.unionByName(rows, allowMissingColumns=True)
    # one shuffle: both aggregates are satisfied by the partitioning on key_article
    per_line = (facts.repartition(n, "key_article").groupBy("key_article", "ppl")
                .agg(*[F.sort_array(F.collect_list(k)).alias(k) for k in kinds]))
    no_line, is_default = F.col("ppl").isNull(), F.col("ppl") == F.lit(cfg.default_line)
    line_entry = F.when(~no_line & ~is_default, F.struct("ppl", F.struct("price", "sale").alias("v")))
    facts = per_line.groupBy("key_article").agg(
        F.map_from_entries(F.collect_list(line_entry)).alias("m"),
        F.flatten(F.collect_list(F.when(no_line, F.col("promo")))).alias("promo"),
        F.flatten(F.collect_list(F.when(no_line, F.col("unav")))).alias("unav"),
        F.flatten(F.collect_list(F.when(is_default, F.col("price")))).alias("defp"))

    # articles and facts join on key_article alone; spans become arrays by day, one for each article or line,
    # and every output row takes its day's entries from them (no lookup by key, no join per row)
    def value(x):
        return x["v"]

    j = attrs.repartition(n, "key_article").join(facts.hint("shuffle_hash"), "key_article", "left")
    j = j.select("key_article", *carried, "m", *[_by_day(F.col(c), cfg, value).alias(c) for c in ("promo", "unav", "defp")])
    j = j.select("*", F.explode(F.array(*[F.lit(x) for x in sell_lines])).alias("ppl"))
    v = F.try_element_at(F.col("m"), F.col("ppl"))
    _, post = regime_line(F.lit(_shift_key(cfg) + 1), "ppl", _shift_key(cfg), cfg.regime_lines)
    j = j.select("key_article", *carried, "promo", "unav", "defp", "ppl", post.alias("_post"),
                 *[_by_day(v.getField(c), cfg, value).alias(c) for c in ("price", "sale")],
                 cal_w.agg(F.sort_array(F.collect_list(day))).scalar().alias("_days"))
    j = j.select(*[c for c in j.columns if c != "_days"], F.inline("_days"))
    at = {c: F.get(F.col(c), F.col("_i")) for c in ("promo", "unav", "defp", "price", "sale")}
    row = {c: F.col(c) for c in ("key_article", "key_date", "date", "ppl", "shift", "avg_high_temp", "weather_type", "key_week", *carried)}
    row |= {"ppln": F.when(F.col("shift") == "post", F.col("_post")).otherwise(F.col("ppl")),
            "aor": at["sale"]["aor"], "nr_orders_day_ppl": at["sale"]["nr_orders_day_ppl"],
            "sum_regular_art_sales_ppl": at["sale"]["sum_regular_art_sales_ppl"],
            "price_in_cents": F.coalesce(at["price"], at["defp"]), "price_in_cents_default": at["defp"],
            "promo_dummy": F.coalesce(at["promo"], F.lit(0)), "unavailability_perc": at["unav"]}
    columns = [c for c in DAILY_COLUMNS if c in row] + ([PACKED] if packed else [])
    return j.select(*[row[c].alias(c) for c in columns])


def _shift_key(cfg: PanelConfig) -> int:
    d = cfg.shift_date
    return d.year * 10000 + d.month * 100 + d.day


# ---------------------------------------------------------------- weekly

WEEKLY_KEYS = ["key_article", "key_week", "ppl"]
# article attributes: functionally dependent on key_article, carried as grouping
# keys (hash aggregate, no string max buffers, no extra shuffle)
WEEKLY_ATTRS = ["article_name", "article_tier", "article_cat_1", "article_cat_2", "article_cat_3",
                "article_cat_4", "article_id", "art_content_volume", "art_is_multipack"]
# those without doubles (which grouping would take apart row by row), as one column of the daily table
PACKED, PACKED_ATTRS = "article", [c for c in WEEKLY_ATTRS if c != "art_content_volume"]


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder."""
    from demandlab.session import scratch_table
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def weekly(daily: DataFrame, cfg: PanelConfig | None = None, checkpoint: bool = True,
           ordered: bool = False) -> DataFrame:
    """Day -> week roll-up per (article, week, line) (A8; rules are ours, §2.12).

    product_order_amt  sum of regular sales        total_order_amt  sum of daily orders
    avg_sell_price     avg price in force          avg_purchase_price avg default-line price
    averages of unavailability and temperature, promo_dummy = max,
    nr_articles_in_cat(_2): distinct priced articles per (week, category level 1 / 2).

    The daily table comes partitioned by ``key_article``, so the roll-up needs
    no shuffle. With ``cfg`` the level-1 counts (one category: at most the
    weeks of the period) are broadcast; the planner decides on the level-2 counts by their size.
    The weekly aggregate feeds three consumers (rows and two counts); with
    ``checkpoint`` it is written once, as a table in the shared checkpoint folder
    (this also cuts the long panel lineage, and consumers read only their
    columns), else the daily side is recomputed per consumer. ``ordered`` sorts
    its rows by the keys within each task: a text file of them is compressed better.
    """
    packed = PACKED in daily.columns
    attrs = [PACKED, *[c for c in WEEKLY_ATTRS if c not in PACKED_ATTRS]] if packed else WEEKLY_ATTRS
    agg = daily.groupBy(*WEEKLY_KEYS, *attrs).agg(
        F.sum("sum_regular_art_sales_ppl").alias("product_order_amt"),
        F.sum("nr_orders_day_ppl").alias("total_order_amt"),
        F.avg("price_in_cents").alias("avg_sell_price"),
        F.avg("price_in_cents_default").alias("avg_purchase_price"),
        F.avg("unavailability_perc").alias("avg_unavailability_perc"),
        F.avg("avg_high_temp").alias("avg_high_temp"),
        F.max("promo_dummy").alias("promo_dummy"),
        F.min("date").alias("_d0"),
        F.count("price_in_cents").alias("_np"))
    if packed:
        agg = agg.select("*", f"{PACKED}.*").drop(PACKED)
    if ordered:
        agg = agg.sortWithinPartitions(*WEEKLY_KEYS)
    if checkpoint:
        agg = _written(agg, "weekly")
    # distinct priced articles per (week, category): counted on the weekly rows
    # (an article counts when any of its days that week has a price), so the
    # daily table is read once; the two counts reuse the weekly aggregate.
    priced = agg.where(F.col("_np") > 0)
    n1 = priced.groupBy("key_week", "article_cat_1").agg(
        F.count_distinct("key_article").alias("nr_articles_in_cat"))
    n2 = priced.groupBy("key_week", "article_cat_2").agg(
        F.count_distinct("key_article").alias("nr_articles_in_cat_2"))
    if checkpoint:
        # written, the counts have a known size: planned from their estimates, the join shuffled the weekly rows
        n1, n2 = (_written(n, "articles") for n in (n1, n2))
    if cfg is not None:
        weeks = cfg.period_days // 7 + 2
        n1 = _bounded_broadcast(n1, weeks)
    ws = F.to_date(F.date_trunc("week", F.col("_d0")))
    out = (agg.join(n1, ["key_week", "article_cat_1"], "left")
              .join(n2, ["key_week", "article_cat_2"], "left"))
    return out.select(
        *WEEKLY_KEYS, "product_order_amt", "total_order_amt", "avg_sell_price",
        "avg_purchase_price", "avg_unavailability_perc", "avg_high_temp",
        F.coalesce("nr_articles_in_cat", F.lit(0)).cast("long").alias("nr_articles_in_cat"),
        F.coalesce("nr_articles_in_cat_2", F.lit(0)).cast("long").alias("nr_articles_in_cat_2"),
        (F.extract(F.lit("YEAROFWEEK"), ws) * 100 + F.weekofyear(ws)).cast("int").alias("year_calendar_week"),
        ws.alias("week_start_date"),
        "article_name", "promo_dummy", "article_tier", "article_cat_1", "article_cat_2",
        "article_cat_3", "article_cat_4", "article_id", "art_content_volume", "art_is_multipack")


__all__ = [
    "assortment", "select_articles", "article_attributes", "period_dates", "price_lines",
    "skeleton", "orders_per_line", "aor", "latest_price_per_day", "prices", "default_prices",
    "price_spans", "promo_days", "promo_flags", "unavailability", "weather", "daily_features", "weekly", "DAILY_COLUMNS", "dense_partitions",
    "presence_flag", "key_of_date",
]
