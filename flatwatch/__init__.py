"""Spark-native property-listing snapshots: landed pages -> posts -> cleaned listings -> dated snapshot -> summaries."""

from .operators.enrich import enrich
from .operators.summary import city_summary, city_summary_history, main_city_summary
from .plans.pipeline import ingest, run

__all__ = ["enrich", "city_summary", "city_summary_history", "main_city_summary", "ingest", "run"]
