"""Export a stored snapshot to the relational store, repeatably.

The original job appended every run to three tables, so a retried run duplicated its rows. Here each table
first loses the rows of the snapshot date (one DELETE statement on the driver -- a control statement, no data
passes through it), then the date's stored partitions are appended by the executors through Spark's JDBC
writer.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from .snapshot import read_snapshot, write_jdbc

DEFAULT_TABLES = {"listings": "LISTINGS", "summary": "CITY_SUMMARY", "main_summary": "MAIN_CITIES_SUMMARY"}


def delete_date(spark: SparkSession, url: str, table: str, snapshot_date, properties: dict | None = None) -> int:
    """Delete a date's rows from ``table``; 0 when the table does not exist yet."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k != "driver":
            props.setProperty(k, v)
    if properties and "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        meta = conn.getMetaData()
        found = False
        for name in {table, table.upper(), table.lower()}:
            rs = meta.getTables(None, None, name, None)
            found = found or rs.next()
            rs.close()
        if not found:
            return 0
        d = snapshot_date if isinstance(snapshot_date, _dt.date) else _dt.date.fromisoformat(str(snapshot_date))
        # Spark's writer creates columns with the dialect's quoted identifiers; a table made elsewhere may not
        quoted = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier("download_date")
        last_error = None
        for column in (quoted, "download_date"):
            try:
                stmt = conn.prepareStatement(f"DELETE FROM {table} WHERE {column} = ?")
            except Exception as e:          # unknown column spelling: try the next one
                last_error = e
                continue
            stmt.setDate(1, jvm.java.sql.Date.valueOf(d.isoformat()))
            n = stmt.executeUpdate()
            stmt.close()
            return n
        raise last_error
    finally:
        conn.close()


def export_snapshot(spark: SparkSession, snapshot_date, paths: dict[str, str], url: str,
                    properties: dict | None = None, tables: dict[str, str] | None = None,
                    column_types: dict[str, str] | None = None, num_partitions: int = 8) -> None:
    """Replace ``snapshot_date`` in the JDBC tables with the stored snapshot and summaries.

    ``paths`` maps 'listings', 'summary', 'main_summary' to the Parquet tables written by ``pipeline.run``.
    """
    tables = tables or DEFAULT_TABLES
    for key, path in paths.items():
        table = tables[key]
        delete_date(spark, url, table, snapshot_date, properties)
        df = read_snapshot(spark, path, snapshot_date)
        write_jdbc(df, url, table, properties, mode="append",
                   column_types=(column_types or {}).get(key), num_partitions=num_partitions)
