"""Best-fit packing after Martello-Toth dominance reduction.

Only the histogram of piece lengths (at most ``capacity`` counts) reaches the driver. Equal lengths are interchangeable,
so the reduction and the best-fit run on (length, count) classes and yield patterns -- lengths that share a sequence --
with a multiplicity. Pieces are then numbered within their length on the cluster and take the slots of the patterns.

Reduction, largest length s first, r = capacity - s being what is left beside it. A set is fixed for good where it
dominates every other set that holds a piece of length s:

* nothing fits into r: the piece alone;
* a piece of just r is there: that pair;
* no two pieces fit into r together: the pair with the largest piece that fits;
* two fit but no three, and the largest single piece is at least the best sum of two: that pair;
* two fit but no three, and the pair made of the largest piece and the largest one beside it is at least as large,
  piece by piece, as any two that fit: that triple.

What is left goes by best-fit in decreasing order of length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import table
from flatwatch.llm.token_pieces import END_ID, encoder, token_pieces
from flatwatch.session import materialize

#: A pattern: ((length, times), ...) in order of place, and how many sequences follow it.
Pattern = tuple[tuple[tuple[int, int], ...], int]


class Classes:
    """Counts by length with the lengths in use kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, s: int, times: int) -> None:
        self.n[s] -= times
        if not self.n[s]:
            del self.n[s]
            self.sizes.pop(bisect_left(self.sizes, s))

    def give(self, s: int, times: int) -> None:
        if s not in self.n:
            insort(self.sizes, s)
        self.n[s] = self.n.get(s, 0) + times

    def largest(self, room: int) -> int:
        """The largest length of at most ``room``, or 0."""
        at = bisect_right(self.sizes, room)
        return self.sizes[at - 1] if at else 0

    def smallest(self, k: int) -> list[int]:
        """The ``k`` smallest pieces; fewer if there are no more."""
        out: list[int] = []
        for s in self.sizes[:k]:
            out += [s] * min(self.n[s], k - len(out))
            if len(out) == k:
                break
        return out

    def pairs(self, room: int) -> list[tuple[int, int]]:
        """For every length x the largest y <= x that fits beside it."""
        out = []
        for x in self.sizes:
            y = self.largest(min(x, room - x))
            if y == x and self.n[x] < 2:
                at = bisect_left(self.sizes, x)
                y = self.sizes[at - 1] if at else 0
            if y > 0 and x + y <= room:
                out.append((x, y))
        return out


def companions(c: Classes, room: int) -> tuple[int, ...] | None:
    """The pieces (one piece already taken out of ``c``) that dominate all that may share ``room``; None if unknown."""
    k = c.largest(room)
    if not k:
        return ()
    if k == room:
        return (k,)
    few = c.smallest(3)
    if len(few) < 2 or few[0] + few[1] > room:
        return (k,)
    if len(few) == 3 and sum(few) <= room:
        return None
    pairs = c.pairs(room)
    if k >= max(x + y for x, y in pairs):
        return (k,)
    beside = dict(pairs).get(k, 0)
    if beside and all(y <= beside for _, y in pairs):
        return (k, beside)
    return None


def reduce_classes(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """(patterns fixed for good, counts left)."""
    c, fixed = Classes(counts), []
    for s in sorted(counts, reverse=True):
        while c.n.get(s):
            c.take(s, 1)
            mates = companions(c, capacity - s)
            c.give(s, 1)
            if mates is None:
                break
            group = (s, *mates)
            need = {x: group.count(x) for x in group}
            times = min(c.n[x] // k for x, k in need.items())   # what dominates can't change before a class runs out
            for x, k in need.items():
                c.take(x, k * times)
            fixed.append((tuple(need.items()), times))
    return fixed, dict(c.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on classes: each length goes where the least room is that holds it."""
    rooms = Classes({})
    open_: dict[int, list[list]] = {}

    def put(room: int, pattern: tuple, times: int) -> None:
        if times:
            open_.setdefault(room, []).append([pattern, times])
            rooms.give(room, times)

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            at = bisect_left(rooms.sizes, s)
            if at < len(rooms.sizes):
                room = rooms.sizes[at]
                group = open_[room][-1]
            else:
                room, group = capacity, [(), -(-left // (capacity // s))]
            pattern, times = group
            each = room // s
            full = min(times, left // each)
            part = 1 if full < times and left - full * each else 0
            rest = (left - full * each) if part else 0
            if at < len(rooms.sizes):
                group[1] -= full + part
                if not group[1]:
                    open_[room].pop()
                rooms.take(room, full + part)
            put(room - each * s, (*pattern, (s, each)), full)
            if part:
                put(room - rest * s, (*pattern, (s, rest)), 1)
            left -= full * each + rest
    return [(pattern, times) for groups in open_.values() for pattern, times in groups]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns for all pieces: the reduction's first, then best-fit for the remainder."""
    if any(not 1 <= s <= capacity for s in counts):
        raise ValueError("a piece must have between one token and the capacity")
    fixed, left = reduce_classes(counts, capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Ranges of ranks: pieces ``first`` and up of a length fill the sequences ``sequence`` and up, ``period`` each round."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for s, each in pattern:
            first = used.get(s, 0)
            rows.append((s, first, sequence, times, offset))
            used[s] = first + times * each
            offset += s * each
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "sequence", "period", "offset"), cols))


def ranked(pieces: DataFrame, keys: list[str], per_group: int = 100_000) -> DataFrame:
    """``pieces`` with ``rank`` from 0 within their length, numbered in salted groups.

    A length may hold any share of all pieces (cut documents give mostly full ones): each is numbered in at least 32
    groups, and more as the table grows, and groups are then laid end to end by their counts.
    """
    n = pieces.count()
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*keys), F.lit(max(32, -(-n // per_group)))))
    own = salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*keys)) - 1)
    sums = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return own.join(starts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth")).drop("salt", "nth", "before")


def pack(pieces: DataFrame, capacity: int, keys: list[str]) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``; ``keys`` tell pieces apart. No pieces: no rows."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}   # at most ``capacity`` rows
    at = slots(plan(counts, capacity))
    marks = at["length"] << 44 | at["first"]

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(marks, length << 44 | rank, side="right") - 1
            nth = rank - at["first"][i]
            new = {"sequence_id": at["sequence"][i] + nth % at["period"][i],
                   "offset": at["offset"][i] + length * (nth // at["period"][i])}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in new.values())],
                                             names=[*batch.schema.names, *new])

    source = ranked(pieces, keys)
    schema = T.StructType([*source.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return source.mapInArrow(place, schema).drop("rank")


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
                   make_encoder=encoder) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    Null and empty texts are one piece, the end id. Longer documents than ``capacity`` are cut into full pieces, the
    first one shorter. Repeated rows are packed as often as they come; a null doc_id stays null. Other columns of
    ``docs`` are ignored. An empty table gives no rows.
    """
    pieces = materialize(token_pieces(docs, capacity, end_id, doc_id, text, make_encoder=make_encoder), "pieces")
    return pack(pieces, capacity, ["doc_id", "piece", "start", "length", "ids_crc32"])


def op1_best_fit_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 1,024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
