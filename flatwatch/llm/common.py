"""Helpers shared by the corpus operators: table access, row keys, and Arrow mapping in small slices."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that a worker turns into Python objects at once.
SLICE_ROWS = 256

#: Whitespace of the word rule [^\x20\x09-\x0D]+; ``bytes.split()`` without arguments splits on just these.
WORD_SPACE = " \\t-\\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; any store that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """64-bit key of a row's identity. Rows equal in ``cols`` (nulls included) share it: they count as one."""
    return F.xxhash64(*[F.col(c) for c in cols])


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


#: Salts of the rows of a hot key: the bits of a long.
SALTS = 64


def salted(df: DataFrame) -> DataFrame:
    """``df`` with ``__salt``, dealt out in turn. Write it before use: a row has to keep its salt when a task is repeated."""
    return df.withColumn("__salt", (F.monotonically_increasing_id() % SALTS).cast("int"))


def salts_seen() -> Column:
    """Aggregate: the salts of a group's rows as bits."""
    return F.expr("bit_or(shiftleft(1L, __salt))")


def each_salt(seen: Column) -> Column:
    """A row for every salt in ``seen``: what is joined back on key and salt has no more rows than the rows it joins."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit(seen, s) == 1))


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               setup: Callable[[], Callable] | None = None) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` at most ``SLICE_ROWS`` rows at a time (bounded Python memory).

    ``setup`` builds per-task state (a tokenizer, say) and returns the function to use instead of ``fn``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = setup() if setup else fn
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield f(batch.slice(start, SLICE_ROWS))

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """The strings of a column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``keep`` columns of the batch followed by ``new`` ones."""
    return pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + list(new.values()), names=[*keep, *new])


def crc_fold(doc_id: int, parts: int) -> int:
    """Python twin of :func:`fold`, for tests."""
    return zlib.crc32(str(doc_id).encode()) % parts


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
