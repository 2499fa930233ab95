"""Driver tables -> listing-shaped frames, so every operator runs on data that grows with the tables.

``listing_view`` maps lineitem x orders x customer x nation onto the cleaned-listing columns; the ``*_texts``
builders render raw field texts (prices, locations, spans, areas) from table columns in the formats the portals
use. The same renderings are written in SQL in ``oracles.py``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

# --- fixed values of the test mapping --------------------------------------------------------------------
SNAPSHOT_DATE = _dt.date(1998, 6, 1)            # a Monday: one weekly snapshot
TEST_KEYWORDS = ("URGENT", "HIGH")               # urgency keywords that occur in o_orderpriority
TEST_MAIN_CITIES = tuple(f"NATION_{i}" for i in range(18))   # 18 "main cities" among the 25 nation names
NBSP = "\u00a0"
ASK_NFC = "Zapytaj o cen\u0119"                # "ask for price", precomposed
ASK_NFD = "Zapytaj o cene\u0328"               # same text, decomposed
# ----------------------------------------------------------------------------------------------------------


# Fact inputs with heavy per-row work, and their key: a single-file copy is spread over all cores by hash.
# Dimension-like tables are left alone (they are broadcast or joined as they are).
SPREAD_KEYS = {"lineitem": "l_orderkey", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str, columns=None, spread_out: bool = True) -> DataFrame:
    """A driver table, pruned to ``columns`` at the scan and spread over all cores when it is one big file.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns is not None:
        df = df.select(*columns)
    key = SPREAD_KEYS.get(name)
    if spread_out and key is not None and (columns is None or key in columns):
        df = spread(df, key)
    return df


def week_of(ts: Column) -> Column:
    """Monday of the week of a wall-clock timestamp (``timestamp_ntz``): no time zone is involved."""
    return F.trunc(ts.cast("date"), "week")


def _ntz(d: _dt.date) -> Column:
    return F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")


def snapshot_window(ts: Column, snapshot_date: _dt.date) -> Column:
    """``week_of(ts) == snapshot_date`` as a range on the raw column, so the scan can skip row groups."""
    if snapshot_date.weekday() != 0:
        return F.lit(False)
    return (ts >= _ntz(snapshot_date)) & (ts < _ntz(snapshot_date + _dt.timedelta(days=7)))


def listing_view(spark: SparkSession, sf_dir: str, snapshot_date: _dt.date | None = None) -> DataFrame:
    """Cleaned listings (LISTING_BASE columns) from the driver tables.

    Join order is left to the optimizer; with a snapshot date the orders scan gets a pushed range filter
    and the lineitem side is reduced by the join (runtime filters / broadcast when the filtered side is small).
    """
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                 "l_returnflag"])
    od = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                               "o_orderpriority"])
    if snapshot_date is not None:
        od = od.filter(snapshot_window(F.col("o_orderdate"), snapshot_date))
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    na = table(spark, sf_dir, "nation", ["n_nationkey", "n_name"], spread_out=False)
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
         .join(cu, od.o_custkey == cu.c_custkey)
         .join(na, cu.c_nationkey == na.n_nationkey))
    in_b = F.col("l_returnflag") == "R"
    return j.select(
        F.col("n_name").alias("post_city"),
        F.col("l_extendedprice").alias("post_price"),
        F.when(in_b, F.lit(None).cast("int")).otherwise(F.col("l_linenumber")).alias("post_rooms"),
        F.when(in_b & (F.col("l_linenumber") == 7), F.lit(None).cast("double"))
        .when(~in_b & (F.col("l_quantity") == 1), F.lit(0.0))
        .otherwise(F.col("l_quantity") * 2.5).alias("post_sqmetrage"),
        F.col("o_orderpriority").alias("post_title"),
        week_of(F.col("o_orderdate")).alias("download_date"),
        F.when(F.col("o_orderstatus") == "O", "rent").when(F.col("o_orderstatus") == "F", "sell")
        .otherwise("room").alias("type"),
        F.when(in_b, "portal_b").otherwise("portal_a").alias("source"),
    )


# ---- raw texts rendered from lineitem -------------------------------------------------------------------

def _amount_parts(price: Column):
    cents = F.round(price * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint")
    frac = cents - whole * 100
    grouped = F.when(whole >= 1000, F.concat((F.floor(whole / 1000)).cast("bigint").cast("string"), F.lit(NBSP),
                                             F.lpad((whole % 1000).cast("string"), 3, "0"))
                     ).otherwise(whole.cast("string"))
    return cents, whole, F.concat(grouped, F.lit(","), F.lpad(frac.cast("string"), 2, "0"))


def price_text_a() -> Column:
    """'12 345,67 zł/mc' (NBSP thousands), '… €', the ask-for-price sentinel in both forms, or free text."""
    _, _, amount = _amount_parts(F.col("l_extendedprice"))
    return (F.when(F.col("l_discount") == 0,
                   F.when(F.col("l_linestatus") == "O", F.lit(ASK_NFC)).otherwise(F.lit(ASK_NFD)))
            .when(F.col("l_tax") == 0, F.lit("do uzgodnienia"))
            .otherwise(F.concat(amount, F.when(F.col("l_returnflag") == "A", F.lit(" €"))
                                .otherwise(F.lit(" zł/mc")))))


def price_text_b() -> Column:
    """'12 345,67 zł do negocjacji', '… zł', or 'Za darmo'."""
    _, _, amount = _amount_parts(F.col("l_extendedprice"))
    return (F.when(F.col("l_discount") == 0, F.lit("Za darmo"))
            .otherwise(F.concat(amount, F.lit(" zł"),
                                F.when(F.col("l_linestatus") == "O", F.lit(" do negocjacji")).otherwise(F.lit("")))))


def rooms_text(c=F.col) -> Column:
    """'<n> pokoje' with n = quantity div 4 (0..12, so two-digit counts occur)."""
    return F.concat(F.floor(c("l_quantity") / 4).cast("bigint").cast("string"), F.lit(" pokoje"))


def area_text_a(c=F.col) -> Column:
    """'<quantity*2.5> m²'; decimal comma for returnflag 'A', a leading space for 'R'."""
    num = (c("l_quantity") * 2.5).cast("string")
    return (F.when(c("l_returnflag") == "A", F.concat(F.replace(num, F.lit("."), F.lit(",")), F.lit(" m²")))
            .when(c("l_returnflag") == "R", F.concat(F.lit(" "), num, F.lit(" m²")))
            .otherwise(F.concat(num, F.lit(" m²"))))


def area_text_b() -> Column:
    """'<quantity/2 with decimal comma> m²' (every odd quantity is a .5 tie); missing for returnflag 'R'."""
    num = F.replace((F.col("l_quantity") / 2).cast("string"), F.lit("."), F.lit(","))
    return F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string")).otherwise(F.concat(num, F.lit(" m²")))


def _span_layouts(wrap, c=F.col):
    """The five span layouts, each a list of (wrapped) texts: [price], [price, area], [price, rooms, area],
    [price, fee, rooms, area], [price, fee, rooms, area, floor]; the count is min(line number, 5)."""
    price = wrap(c("price_text"))
    fee = wrap(F.concat(F.lit("+ czynsz "), F.floor(c("l_tax") * 1000).cast("bigint").cast("string"),
                        F.lit(" zł")))
    rooms, area = wrap(rooms_text(c)), wrap(area_text_a(c))
    floor = wrap(F.concat(F.lit("piętro "), c("l_linenumber").cast("string")))
    return [[price], [price, area], [price, rooms, area], [price, fee, rooms, area], [price, fee, rooms, area, floor]]


def _by_span_count(options, c=F.col) -> Column:
    n = F.least(c("l_linenumber"), F.lit(5))
    out = F.when(n == 1, options[0])
    for k in range(2, 5):
        out = out.when(n == k, options[k - 1])
    return out.otherwise(options[4])


def spans_array() -> Column:
    """The spans of a post as an array (1 to 5 texts)."""
    return _by_span_count([F.array(*layout) for layout in _span_layouts(lambda c: c)])


def spans_html(wrap, c=F.col) -> Column:
    """The spans of a post as markup, each text wrapped by ``wrap``; ``c(name)`` gives the line item's values."""
    return _by_span_count([F.concat(*layout) for layout in _span_layouts(wrap, c)], c)


# ---- locations rendered from customer x nation x region -------------------------------------------------

def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    na = table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"], spread_out=False)
    re_ = table(spark, sf_dir, "region", ["r_regionkey", "r_name"], spread_out=False)
    return cu.join(na, cu.c_nationkey == na.n_nationkey).join(re_, na.n_regionkey == re_.r_regionkey)


def _ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (the names are ASCII; avoids the Unicode case-mapping path of ``lower``)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def location_text_a() -> Column:
    """'ul. Długa <key>, <segment>, <nation>, <region>'; lower-cased names for a negative balance."""
    pos = F.col("c_acctbal") >= 0
    nat = F.when(pos, F.col("n_name")).otherwise(_ascii_lower(F.col("n_name")))
    reg = F.when(pos, F.col("r_name")).otherwise(_ascii_lower(F.col("r_name")))
    return F.concat(F.lit("ul. Długa "), F.col("c_custkey").cast("string"), F.lit(", "), F.col("c_mktsegment"),
                    F.lit(", "), nat, F.lit(", "), reg)


def location_text_b() -> Column:
    """'<nation>, <segment> - dzisiaj' or ' <nation>-<segment>, <region>'."""
    return F.when(F.col("c_acctbal") >= 0,
                  F.concat(F.col("n_name"), F.lit(", "), F.col("c_mktsegment"), F.lit(" - dzisiaj"))
                  ).otherwise(F.concat(F.lit(" "), F.col("n_name"), F.lit("-"), F.col("c_mktsegment"), F.lit(", "),
                                       F.col("r_name")))


def dictionary_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-column grid (nation name, region name): the city dictionary of the tests."""
    na = table(spark, sf_dir, "nation", ["n_name", "n_regionkey"], spread_out=False)
    re_ = table(spark, sf_dir, "region", ["r_regionkey", "r_name"], spread_out=False)
    return na.join(re_, na.n_regionkey == re_.r_regionkey).select(F.col("n_name").alias("c0"),
                                                                  F.col("r_name").alias("c1"))


# ---- generic web pages ----------------------------------------------------------------------------------

def page_lang(url: Column) -> Column:
    """Language path segment of a page URL ('en', 'fr', ...): the page category."""
    return F.regexp_extract(url, r"^[a-z]+://[^/]+/([a-z]{2})/", 1)


def history_summary_preaggregated(spark: SparkSession, sf_dir: str, keywords=None) -> DataFrame:
    """``city_summary_history`` over the listing view, with the line items pre-aggregated per order.

    Every summary aggregate decomposes into sum / count / min / max, so line items are first reduced to one
    partial row per (order, source) -- map-side, before the shuffle to the orders join -- and the partials are
    combined per (date, city, type) after the joins. The constant price per m² of portal-B rooms depends on
    the category, known only after the join, and is applied to the partials there.
    """
    in_b = F.col("l_returnflag") == "R"
    area = (F.when(in_b & (F.col("l_linenumber") == 7), F.lit(None).cast("double"))
            .when(~in_b & (F.col("l_quantity") == 1), F.lit(0.0))
            .otherwise(F.col("l_quantity") * 2.5))
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                           "l_returnflag"])
    lines = li.select("l_orderkey", in_b.alias("in_b"), F.col("l_extendedprice").alias("price"),
                      F.when(in_b, F.lit(None).cast("int")).otherwise(F.col("l_linenumber")).alias("rooms"),
                      area.alias("area"))
    lines = lines.withColumn("ppsqm", F.try_divide(F.col("price"), F.col("area")))

    def partials(c):
        return [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_cnt"), F.min(c).alias(f"{c}_min"),
                F.max(c).alias(f"{c}_max")]
    per_order = lines.groupBy("l_orderkey", "in_b").agg(
        F.count(F.lit(1)).alias("n"), *partials("price"), F.sum("rooms").alias("rooms_sum"),
        F.count("rooms").alias("rooms_cnt"), *partials("area"), *partials("ppsqm"))
    od = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    na = table(spark, sf_dir, "nation", ["n_nationkey", "n_name"], spread_out=False)
    j = (per_order.join(od, per_order.l_orderkey == od.o_orderkey)
         .join(cu, od.o_custkey == cu.c_custkey).join(na, cu.c_nationkey == na.n_nationkey))
    typ = (F.when(F.col("o_orderstatus") == "O", "rent").when(F.col("o_orderstatus") == "F", "sell")
           .otherwise("room"))
    j = j.select("*", typ.alias("type"), week_of(F.col("o_orderdate")).alias("download_date"),
                 F.col("n_name").alias("post_city"))
    room = F.col("in_b") & (F.col("type") == "room")          # portal-B rooms: price per m² is 0 for every post
    j = j.select("download_date", "post_city", "type", "n", "price_sum", "price_cnt", "price_min", "price_max",
                 "rooms_sum", "rooms_cnt", "area_sum", "area_cnt", "area_min", "area_max",
                 F.when(room, F.lit(0.0)).otherwise(F.col("ppsqm_sum")).alias("ppsqm_sum"),
                 F.when(room, F.col("n")).otherwise(F.col("ppsqm_cnt")).alias("ppsqm_cnt"),
                 F.when(room, F.lit(0.0)).otherwise(F.col("ppsqm_min")).alias("ppsqm_min"),
                 F.when(room, F.lit(0.0)).otherwise(F.col("ppsqm_max")).alias("ppsqm_max"))

    def avg(c):
        return F.round(F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_cnt").cast("double")), 0)
    out = j.groupBy("download_date", "post_city", "type").agg(
        avg("price").alias("avg_price"), F.min("price_min").alias("min_price"), F.max("price_max").alias("max_price"),
        avg("rooms").alias("avg_rooms"), avg("area").alias("avg_sqmetrage"),
        F.min("area_min").alias("min_sqmetrage"), F.max("area_max").alias("max_sqmetrage"),
        avg("ppsqm").alias("avg_price_sqm"), F.min("ppsqm_min").alias("min_price_sqm"),
        F.max("ppsqm_max").alias("max_price_sqm"), F.sum("n").alias("number_of_posts"))
    return out.select("post_city", "type", "avg_price", "min_price", "max_price", "avg_rooms", "avg_sqmetrage",
                      "min_sqmetrage", "max_sqmetrage", "avg_price_sqm", "min_price_sqm", "max_price_sqm",
                      "number_of_posts", "download_date")
