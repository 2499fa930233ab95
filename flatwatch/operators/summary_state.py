"""Mergeable summaries: partial states by date, city and type, stored by date.

A state holds what the summary's figures are made of: the exact sum, the count, least and greatest of each column. Sums
are decimal, so they are the same for every order and partitioning of the rows, and so are the means made of them. A new
snapshot adds its date; pages that come late replace the state of their date; a report over any set of dates merges
states, a row per date, city and type, and reads no listing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.snapshot import write_snapshot

#: Listing columns and the names of their figures in the summary.
MEASURES = {"post_price": "price", "post_rooms": "rooms", "post_sqmetrage": "sqmetrage", "price_per_sqm": "price_sqm"}

#: Digits after the point of a value as it is summed; sums have room for 10^18 in front of it.
EXACT, SUM = T.DecimalType(28, 10), T.DecimalType(38, 10)

KEYS = ("download_date", "post_city", "type")

STATE = T.StructType(
    [T.StructField("post_city", T.StringType()), T.StructField("type", T.StringType()), T.StructField("posts", T.LongType())]
    + [f for m in MEASURES.values() for f in (
        T.StructField(f"sum_{m}", SUM), T.StructField(f"n_{m}", T.LongType()),
        T.StructField(f"min_{m}", T.DoubleType()), T.StructField(f"max_{m}", T.DoubleType()))]
    + [T.StructField("download_date", T.DateType())])


def summary_state(listings: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Partial states of ``listings``; partial aggregation before the one shuffle."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("posts")]
    for c, m in MEASURES.items():
        aggs += [F.sum(F.col(c).cast(EXACT)).cast(SUM).alias(f"sum_{m}"), F.count(c).alias(f"n_{m}"),
                 F.min(c).cast("double").alias(f"min_{m}"), F.max(c).cast("double").alias(f"max_{m}")]
    return listings.groupBy(*keys).agg(*aggs)


def merged(state: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """States of coarser or equal ``keys``: sums and counts add up, bounds meet."""
    aggs: list[Column] = [F.sum("posts").alias("posts")]
    for m in MEASURES.values():
        aggs += [F.sum(f"sum_{m}").cast(SUM).alias(f"sum_{m}"), F.sum(f"n_{m}").alias(f"n_{m}"),
                 F.min(f"min_{m}").alias(f"min_{m}"), F.max(f"max_{m}").alias(f"max_{m}")]
    return state.groupBy(*keys).agg(*aggs)


def summary_of(state: DataFrame) -> DataFrame:
    """The summary's columns from states; the mean of no values is NULL."""
    mean = lambda m: F.round(F.try_divide(F.col(f"sum_{m}").cast("double"), F.col(f"n_{m}")), 0).alias(f"avg_{m}")
    bound = lambda f, m: F.col(f"{f}_{m}")
    keys = [c for c in ("post_city", "type") if c in state.columns]
    date = [c if c in state.columns else F.lit(None).cast("date").alias(c) for c in ("download_date",)]
    return state.select(
        *keys, mean("price"), bound("min", "price"), bound("max", "price"), mean("rooms"), mean("sqmetrage"),
        bound("min", "sqmetrage"), bound("max", "sqmetrage"), mean("price_sqm"), bound("min", "price_sqm"), bound("max", "price_sqm"),
        F.col("posts").alias("number_of_posts"), *date)


def merge_snapshot(listings: DataFrame, path: str, snapshot_date=None) -> None:
    """Put the states of the dates in ``listings`` (whole dates) into the table at ``path``; other dates stay."""
    state = summary_state(listings).select(*STATE.fieldNames())
    write_snapshot(state, path, ("download_date",), snapshot_date=snapshot_date)
