"""Derived listing columns: area bucket, urgency flag, price per square metre, constant defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SOURCES
from ..schema import AREA_BUCKET_OTHER, AREA_BUCKETS, NORMAL, URGENCY_KEYWORDS, URGENT

# Categories whose rows carry constant defaults (sqm_bucket '0', price_per_sqm 0): source -> types.
DEFAULT_TYPES = {cfg.name: cfg.default_types for cfg in SOURCES if cfg.default_types}


def area_bucket(area: Column, null_bucket: str = AREA_BUCKET_OTHER) -> Column:
    """'<30', '30-49', '50-74', '75-100' or '>100'. NULL area gets ``null_bucket`` ('>100', as the original)."""
    expr = None
    for label, lo, hi, hi_incl in AREA_BUCKETS:
        cond = (area <= hi) if hi_incl else (area < hi)
        if lo is not None:
            cond = (area >= lo) & cond
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(area.isNull(), F.lit(null_bucket)).otherwise(expr.otherwise(F.lit(AREA_BUCKET_OTHER)))


def urgency(title: Column, keywords: Sequence[str] = URGENCY_KEYWORDS) -> Column:
    """'urgent' when the title contains any keyword (case-sensitive), else 'normal' (also for NULL)."""
    cond = F.lit(False)
    for k in keywords:
        cond = cond | F.coalesce(title.contains(k), F.lit(False))
    return F.when(cond, F.lit(URGENT)).otherwise(F.lit(NORMAL))


def price_per_area(price: Column, area: Column) -> Column:
    """price / area; NULL for a zero or NULL area (never raises under ANSI)."""
    return F.try_divide(price, area)


def defaulted(default_types: Mapping[str, Sequence[str]] | None = None) -> Column:
    default_types = DEFAULT_TYPES if default_types is None else default_types
    cond = F.lit(False)
    for src, types in default_types.items():
        cond = cond | ((F.col("source") == src) & F.col("type").isin(*types))
    return cond


def enrich(listings: DataFrame, keywords: Sequence[str] = URGENCY_KEYWORDS,
           default_types: Mapping[str, Sequence[str]] | None = None,
           null_bucket: str = AREA_BUCKET_OTHER) -> DataFrame:
    """``select('*', sqm_bucket, urgency, price_per_sqm)`` in one projection."""
    d = defaulted(default_types)
    return listings.select(
        "*",
        F.when(d, F.lit("0")).otherwise(area_bucket(F.col("post_sqmetrage"), null_bucket)).alias("sqm_bucket"),
        urgency(F.col("post_title"), keywords).alias("urgency"),
        F.when(d, F.lit(0.0)).otherwise(price_per_area(F.col("post_price"), F.col("post_sqmetrage")))
        .alias("price_per_sqm"),
    )
