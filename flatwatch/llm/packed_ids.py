"""Packed token-id matrices: best-fit-decreasing with a segment tree over capacities, written as binary columns.

Pieces are dealt into groups by a hash of their identity, so a group holds about ``group_bytes`` of ids whatever
document or source they come from; each task packs its groups, one at a time, and assembles the rows. The tree counts
open sequences by the room they have left: the least room that holds a piece is one descent.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import table
from flatwatch.llm.token_pieces import END_ID, encoder, token_pieces
from flatwatch.session import scratch_path

#: Sequences of one group; the group's number takes the bits above.
GROUP_BITS = 32


class RoomTree:
    """Counts by room (0 to ``capacity``) in a segment tree; finds the least room in use that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, room: int) -> int | None:
        at = room + self.leaves
        if self.count[at]:
            return room
        while at > 1:
            if at & 1 == 0 and self.count[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; equal lengths go in the order given."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, by_room, n = RoomTree(capacity), {}, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = tree.least(size)
        if room is None:
            room, at, n = capacity, n, n + 1
        else:
            at = by_room[room].pop()
            tree.add(room, -1)
        sequence[i], offset[i] = at, capacity - room
        if room > size:
            by_room.setdefault(room - size, []).append(at)
            tree.add(room - size, 1)
    return sequence, offset


def assemble(group: pa.Table, capacity: int, pad_id: int, dtype: str) -> pa.Table:
    """One row per sequence of the group: the padded ids and where its pieces begin."""
    lengths = group.column("length").to_numpy()
    sequence, offset = best_fit_decreasing(lengths, capacity)
    order = np.lexsort((offset, sequence))
    raw = group.column("ids").to_pylist()
    docs, pieces = group.column("doc_id").take(pa.array(order)), group.column("piece").to_numpy()[order]
    bounds = np.flatnonzero(np.diff(sequence[order], prepend=-1))
    ends = np.append(bounds[1:], len(order))
    blank = np.full(capacity, pad_id, dtype).tobytes()
    width = np.dtype(dtype).itemsize
    first = int(group.column("group")[0].as_py()) << GROUP_BITS
    ids, cumulative, positions, total = [], [], [], []
    for s, e in zip(bounds.tolist(), ends.tolist()):
        row = b"".join(raw[i] for i in order[s:e].tolist())
        ids.append(row + blank[len(row):])
        cu = np.concatenate(([0], np.cumsum(lengths[order[s:e]])))
        cumulative.append(cu.astype(np.int32))
        reset = np.arange(capacity) - np.repeat(np.append(cu[:-1], cu[-1]), np.append(np.diff(cu), capacity - cu[-1]))
        positions.append(reset.astype("<u4" if capacity > 1 << 16 else "<u2").tobytes())
        total.append(len(row) // width)
    lists = pa.array(np.append(bounds, len(order)).astype(np.int32))
    return pa.table({
        "sequence_id": pa.array(np.arange(len(bounds)) + first), "n_tokens": pa.array(total, pa.int32()),
        "ids": pa.array(ids, pa.binary()), "cu_seqlens": pa.array(cumulative, pa.list_(pa.int32())),
        "positions": pa.array(positions, pa.binary()),
        "doc_ids": pa.ListArray.from_arrays(lists, docs.combine_chunks()),
        "pieces": pa.ListArray.from_arrays(lists, pa.array(pieces, pa.int32()))})


def packed(docs: DataFrame, capacity: int = 2048, pad_id: int = 0, end_id: int = END_ID, vocabulary: int = 50_257,
           group_bytes: int = 4_000_000, doc_id: str = "doc_id", text: str = "text", make_encoder=encoder) -> DataFrame:
    """(sequence_id, n_tokens, ids, cu_seqlens, positions, doc_ids, pieces): one row per packed sequence.

    ``ids``: ``capacity`` little-endian ids (two bytes each if the vocabulary fits, else four), ``pad_id`` at the end;
    ``cu_seqlens``: 0 and the end of each piece; ``positions``: counts from 0 in every piece and in the padding.
    ``doc_ids`` and ``pieces`` name the pieces in order; the pieces of a document in order are its ids and the end id.
    Null and empty texts are the end id alone; a null doc_id stays null; repeated rows come as often as they are.
    Other columns are ignored. An empty table gives no rows.
    """
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, -(-total // (2 * group_bytes)))              # a token has two bytes or more of text, and two of ids
    pieces = token_pieces(docs, capacity, end_id, doc_id, text, ids=dtype, make_encoder=make_encoder)
    dealt = pieces.select(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).alias("group"),
                          "doc_id", "piece", "length", "ids")
    kind = T.StructType([T.StructField("doc_ids", T.ArrayType(docs.schema[doc_id].dataType))])
    schema = T.StructType(T._parse_datatype_string(
        "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary").fields
        + kind.fields + T._parse_datatype_string("pieces array<int>").fields)
    return dealt.groupBy("group").applyInArrow(lambda t: assemble(t, capacity, pad_id, dtype), schema)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """The rows of :func:`packed` as Parquet, binary columns for the matrices; an existing table is replaced."""
    packed(docs, **options).write.mode("overwrite").option("compression", "zstd").parquet(path)


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as packed sequences of 2,048 ids and read back: what each row holds, and its checksums."""
    path = scratch_path(spark, "packed-ids")
    write_packed(table(spark, sf_dir, "documents"), path)
    return spark.read.parquet(path).select(
        "sequence_id", "n_tokens", "doc_ids", "pieces", "cu_seqlens", F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"))
