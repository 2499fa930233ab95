"""Event-driven snapshots: run the batch job whenever pages land.

Landed pages arrive as Parquet files below a landing folder partitioned by ``download_date``. A file-source
stream notices new files (its checkpoint remembers which were seen); each micro-batch looks up the snapshot
dates it touched and re-runs ``pipeline.run`` for those dates over *all* pages landed for them. The skip of
promoted posts needs a date's whole page set, so a date is always recomputed as a whole -- and because every
write replaces exactly that date's partitions, a replayed micro-batch changes nothing.

With a catalogue of expected pages a date is published only when its required pages have landed. What has landed is
stored by date (``status_path``), so ``overdue`` can report dates that are past their deadline, also if nothing arrives.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import SOURCES, SourceConfig
from ..plans.pipeline import run
from ..schema import PAGE
from ..sinks.snapshot import read_snapshot, write_snapshot
from ..sources.pages import missing_pages

LANDED_PAGE = T.StructType(PAGE.fields + [T.StructField("download_date", T.DateType(), True)])

def landed_pages(spark: SparkSession, landing_dir: str) -> DataFrame:
    """All pages landed so far (batch read, partition-pruned by a later date filter)."""
    return spark.read.schema(LANDED_PAGE).parquet(landing_dir)


STATUS = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("type", T.StringType()), T.StructField("expected", T.LongType()),
    T.StructField("missing", T.LongType()), T.StructField("missing_required", T.LongType()),
    T.StructField("download_date", T.DateType())])


def landing_status(catalogue: DataFrame, pages: DataFrame, date: _dt.date) -> DataFrame:
    """Per source and type, how many of a date's expected pages there are and how many have not landed."""
    lack = missing_pages(catalogue, pages).select("source", "type", "page", F.lit(1).alias("lacks"))
    return (catalogue.join(lack.distinct(), ["source", "type", "page"], "left").groupBy("source", "type").agg(
        F.count(F.lit(1)).alias("expected"), F.count("lacks").alias("missing"),
        F.count_if(F.col("lacks").isNotNull() & F.col("required")).alias("missing_required"))
        .withColumn("download_date", F.lit(date).cast("date")).select(*STATUS.fieldNames()))


def overdue(spark: SparkSession, status_path: str, now: _dt.datetime, hours: float = 24) -> DataFrame:
    """Status rows of dates that still lack required pages ``hours`` after the date began."""
    status = read_snapshot(spark, status_path, schema=STATUS)
    last = (now - _dt.timedelta(hours=hours)).date()
    return status.filter((F.col("missing_required") > 0) & (F.col("download_date") <= F.lit(last)))


def start(spark: SparkSession, landing_dir: str, snapshot_path: str, summary_path: str, main_summary_path: str,
          checkpoint_location: str, cities: DataFrame | None = None,
          configs: Sequence[SourceConfig] = SOURCES, available_now: bool = True,
          max_files_per_trigger: int | None = None, catalogue: DataFrame | None = None,
          status_path: str | None = None, quarantine_path: str | None = None) -> StreamingQuery:
    """Start the watcher. ``available_now`` processes what has landed and stops (a scheduled run);
    otherwise it keeps watching with the default trigger.

    ``catalogue``: the pages expected for every date. A date that lacks a required one is not published, what is missing is
    stored below ``status_path``, and the page's arrival makes it complete. Without a catalogue every date is published."""
    if (catalogue is None) != (status_path is None):
        raise ValueError("catalogue and status_path go together")
    reader = spark.readStream.schema(LANDED_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    arrivals = reader.parquet(landing_dir).select("download_date")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        dates = [r[0] for r in batch.select("download_date").distinct().collect()]      # one per day landed
        if None in dates:
            raise ValueError(f"micro-batch {batch_id} has pages without a download date")
        for d in sorted(dates):
            pages = landed_pages(spark, landing_dir).filter(F.col("download_date") == F.lit(d))
            if catalogue is not None:
                write_snapshot(landing_status(catalogue, pages, d), status_path, ("download_date",), snapshot_date=d)
                if not read_snapshot(spark, status_path, d, STATUS).filter("missing_required > 0").isEmpty():
                    continue
            run(spark, pages.drop("download_date"), snapshot_path, summary_path, main_summary_path,
                cities=cities, configs=configs, snapshot_date=d, quarantine_path=quarantine_path)

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
