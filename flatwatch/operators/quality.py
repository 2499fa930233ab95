"""Per-category counts of values that cleaning could not produce (a NULL instead of a failed job)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SourceConfig
from ..functions.markup import let
from .clean import FAULTS, clean_price_text, parse_price, price_value


def listing_quality(listings: DataFrame, keys: Sequence[str] = ("download_date", "source", "type")) -> DataFrame:
    """Posts per key and how many lack a price, a city or an area, or have a zero area."""
    def missing(c: str):
        return F.count_if(F.col(c).isNull())
    return listings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("number_of_posts"),
        missing("post_price").alias("missing_price"),
        missing("post_city").alias("missing_city"),
        missing("post_sqmetrage").alias("missing_area"),
        F.count_if(F.col("post_sqmetrage") == 0).alias("zero_area"),
    )


def price_status(text: Column, cfg: SourceConfig) -> Column:
    """Why a price text has no value: 'missing' element, the portal's 'ask' text, or 'unparseable'; 'ok' if it has one."""
    def status(clean: Column, value: Column) -> Column:
        asks = clean.isin(*cfg.price_sentinels) if cfg.price_sentinels else F.lit(False)
        return F.when(clean.isNull(), "missing").when(asks, "ask").when(value.isNull(), "unparseable").otherwise("ok")

    clean = clean_price_text(text, cfg.price_replacements, ())
    if cfg.price_full_nfkd:
        return status(clean, parse_price(text, cfg))
    # a sentinel is told from the cleaned text before its value is asked for, so both have the same text
    return let(clean, lambda c: status(c, price_value(c, cfg.price_mode)))


def quarantined(posts: DataFrame) -> DataFrame:
    """Posts of ``clean_posts(with_faults=True)`` that have a fault, with their texts as found."""
    return posts.filter(F.col("faults") != 0).select("source", "type", "page", "pos", "faults", "texts.*")


def fault_counts(quarantine: DataFrame, keys: Sequence[str] = ("source", "type")) -> DataFrame:
    """Posts per key and fault; a post with several faults counts for each. Partial aggregation on the bits."""
    each = F.explode(F.filter(F.array(*[F.when(F.getbit("faults", F.lit(i)) == 1, F.lit(name)) for i, name in enumerate(FAULTS)]),
                              lambda x: x.isNotNull()))
    per_bits = quarantine.groupBy(*keys, "faults").agg(F.count(F.lit(1)).alias("n"))
    return per_bits.select(*keys, each.alias("fault"), "n").groupBy(*keys, "fault").agg(F.sum("n").alias("number_of_posts"))
