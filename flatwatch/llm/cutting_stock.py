"""Packing by cutting-stock column generation.

Only the histogram of piece lengths (at most ``capacity`` counts) reaches the driver. Lengths are read on a grid, and a
pattern is a multiset of grid lengths that fits into one sequence. The linear program "fewest sequences that hold every
piece" has one row per grid length; its columns are not listed but priced: given the duals of the present basis, an
unbounded knapsack by dynamic programming finds the pattern of the greatest value, which enters the basis while it is
worth more than the sequence it costs. Pattern multiplicities are rounded down, then up by their fraction where pieces
are left, and the slots of a pattern go to the pieces of its grid length in order of rank, the longest first.

The gaps that rounding to the grid leaves, and the pieces that the rounding of the program leaves, cancel each other:
pieces left over are cut to just fill the gaps, sequences of nothing else are filled in the same way, and the tokens
that make no full sequence go into sequences of powers of two, which need no padding. If there are more gaps than
pieces left, the sequences with the widest gaps are taken apart. So no sequence is padded, and only pieces left over are
cut. All of this runs on (length, first rank, count) runs, whose number depends on the capacity and not on the corpus;
the cluster ranks the pieces within their length and looks their places up.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.best_fit_reduction import ranked
from flatwatch.llm.common import map_slices, table, texts
from flatwatch.llm.token_pieces import encoder, piece_bounds
from flatwatch.session import materialize

CAPACITY, END_ID = 2048, 1

#: Tokens of a step of the length grid: 256 rows of the linear program for sequences of 2,048.
GRID = 8

#: The program stops once its value is proven to be within this share (or half a sequence) of the optimum.
GAP = 1e-5


# --- the linear program --------------------------------------------------------------------------------------------

def best_pattern(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of ``sizes`` (ascending) of the greatest total ``worth`` that fits ``room``: (value, times of each)."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        value[c], k = value[c - 1], fitting[c]
        if k:
            found = worth[:k] + value[c - sizes[:k]]
            i = int(found.argmax())
            if found[i] > value[c]:
                value[c], last[c] = found[i], i
    times, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            times[last[c]] += 1
            c -= sizes[last[c]]
    return float(value[room]), times


def greedy_patterns(sizes: np.ndarray, need: np.ndarray, room: int) -> np.ndarray:
    """A feasible basis: patterns filled with the largest sizes left, each used until one of its sizes has run out."""
    left, basis = need.copy(), np.zeros((len(sizes), len(sizes)))
    alive = list(range(len(sizes)))
    for column in range(len(sizes)):
        rest = room
        for i in reversed(alive):
            basis[i, column] = rest // sizes[i]
            rest -= basis[i, column] * sizes[i]
        held = np.flatnonzero(basis[:, column])
        ratio = left[held] / basis[held, column]
        left[held] -= ratio.min() * basis[held, column]
        alive.remove(held[ratio.argmin()])
    return basis


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row pivots. Plain array steps: BLAS threads may hang in a process that forked a JVM."""
    m = len(matrix)
    both = np.hstack([matrix, np.eye(m)])
    for i in range(m):
        r = i + int(np.abs(both[i:, i]).argmax())
        both[[i, r]] = both[[r, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= np.multiply.outer(factor, both[i])
    return both[:, m:]


def solve(sizes: np.ndarray, need: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(patterns, multiplicities, feasible duals) of the program over all patterns; patterns are rows of a square matrix.

    Revised simplex from greedy patterns. Duals divided by the greatest worth of a pattern under them are
    feasible (Farley's bound); the best such duals so far, at first plain lengths, steady the pricing: a column is sought
    under a mean of these and the present duals, and under the present ones alone where that finds none. Needs are
    shifted by tiny fixed amounts, so that ties in the ratio test do not make it cycle.
    """
    m = len(sizes)
    target = need + np.random.default_rng(0).uniform(1e-7, 1e-6, m) * np.maximum(need, 1)
    basis = greedy_patterns(sizes, target, room)                    # a column per pattern
    inverse = inverted(basis)
    x, turn = np.maximum((inverse * target).sum(axis=1), 0), 0
    steady = sizes / room
    bound = float((steady * target).sum())
    while x.sum() - bound > max(gap * bound, 0.5):
        duals = inverse.sum(axis=0)
        for prices in (0.8 * steady + 0.2 * np.maximum(duals, 0), np.maximum(duals, 0)):
            worth, times = best_pattern(sizes, prices, room)
            proven = float((prices * target).sum() / worth)
            if proven > bound:
                steady, bound = prices / worth, proven
            if (duals * times).sum() > 1 + 1e-9:
                break
        else:
            break                                                   # no pattern is worth more than its sequence: optimal
        step = (inverse * times).sum(axis=1)
        ratio = np.full(m, np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        r = int(ratio.argmin())
        x, theta = x - ratio[r] * step, ratio[r]
        x[r] = theta
        basis[:, r] = times
        turn += 1
        if turn % 100 == 0:                                         # rounding errors do not pile up
            inverse = inverted(basis)
            x = np.maximum((inverse * target).sum(axis=1), 0)
        else:
            row = inverse[r] / step[r]
            inverse -= np.multiply.outer(step, row)
            inverse[r] = row
    return basis.T.round().astype(np.int64), np.maximum(x, 0), steady


def rounded(patterns: np.ndarray, x: np.ndarray, need: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Whole multiplicities: each rounded down, then one more, greatest fraction first, where enough pieces are left."""
    left, out = need.copy(), np.zeros(len(patterns), np.int64)

    def use(i: int, most: int) -> None:
        held = patterns[i] > 0
        times = min(most, int((left[held] // patterns[i][held]).min()))
        out[i] += times
        left[held] -= times * patterns[i][held]

    whole = np.floor(x + 1e-4).astype(np.int64)
    for i in range(len(patterns)):
        use(i, int(whole[i]))
    for i in np.argsort(whole - x, kind="stable"):
        use(i, 1)
    return [(patterns[i], int(out[i])) for i in range(len(patterns)) if out[i]]


# --- places, on runs of equal pieces -------------------------------------------------------------------------------

@dataclass
class Run:
    """Pieces ``first`` to ``first + count`` of a length, their ids placed up to ``start``. A place (start, length, k,
    sequence, offset): piece ``first + i`` has ``k`` parts of ``length`` from ``start`` on, the j-th in sequence + i k + j."""

    length: int
    first: int
    count: int
    start: int = 0
    places: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def split(self, n: int) -> Run:
        """Keeps the first ``n`` pieces and returns the others."""
        rest = Run(self.length, self.first + n, self.count - n, self.start,
                   [(a, b, k, sequence + n * k, offset) for a, b, k, sequence, offset in self.places])
        self.count = n
        return rest

    def put(self, length: int, k: int, sequence: int, offset: int) -> None:
        self.places.append((self.start, length, k, sequence, offset))
        self.start += k * length

    @property
    def left(self) -> int:
        return self.length - self.start


def assign(counts: dict[int, int], chosen: list[tuple[np.ndarray, int]], sizes: np.ndarray, grid: np.ndarray,
           capacity: int) -> tuple[list[tuple[int, list[Run]]], list[Run]]:
    """(times, one run per slot) of sequences with equal lengths, and the pieces left. ``grid``: the size of each length."""
    stacks: dict[int, list[Run]] = {int(s): [] for s in sizes}
    for n in sorted(counts):
        stacks[int(grid[n])].append(Run(n, 0, counts[n]))              # the longest on top
    groups = []
    for pattern, times in chosen:
        slots = [(stacks[int(sizes[i])], int(pattern[i])) for i in np.flatnonzero(pattern)]
        while times:
            u = min([times] + [max(1, stack[-1].count // k) for stack, k in slots])
            runs = []
            for stack, k in slots:
                for _ in range(k):
                    run = stack.pop()
                    if run.count > u:
                        stack.append(run.split(u))
                    runs.append(run)
            groups.append((u, runs))
            times -= u
    return groups, [run for stack in stacks.values() for run in stack]


def plan(counts: dict[int, int], capacity: int = CAPACITY, grid: int = GRID) -> list[Run]:
    """Runs that cover every piece, with all their places. ``counts``: pieces by length, 1 to ``capacity``."""
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError("a piece must have between one token and the capacity")
    counts = {n: c for n, c in counts.items() if c > 0}
    if not counts:
        return []
    room = max(1, capacity // grid)
    size_of = np.minimum(-(-np.arange(capacity + 1) // grid), room)      # a piece longer than the grid reaches is alone
    sizes, at = np.unique(size_of[list(counts)], return_inverse=True)
    need = np.bincount(at, weights=list(counts.values())).astype(np.int64)
    patterns, x, _ = solve(sizes, need, room)
    groups, free = assign(counts, rounded(patterns, x, need), sizes, size_of, capacity)

    # Gaps and pieces left must come to the same number of tokens: take sequences apart, or add new ones.
    groups.sort(key=lambda g: sum(run.length for run in g[1]), reverse=True)
    gap = sum(times * (capacity - sum(run.length for run in runs)) for times, runs in groups)
    spare = sum(run.length * run.count for run in free)
    apart = max(0, -(-(gap - spare) // capacity))
    while apart:
        times, runs = groups.pop()
        u = min(times, apart)
        free += [run.split(times - u) if u < times else run for run in runs]
        if u < times:
            groups.append((times - u, runs))
        gap -= u * (capacity - sum(run.length for run in runs))
        spare += u * sum(run.length for run in runs)
        apart -= u

    done, gaps, sequence = [], [], 0                                     # gaps: (-tokens, first sequence, times, offset)
    for times, runs in groups:
        offset = 0
        for run in runs:
            run.put(run.length, 1, sequence, offset)
            offset += run.length
            done.append(run)
        if offset < capacity:
            gaps.append((offset - capacity, sequence, times, offset))
        sequence += times
    over = spare - gap
    new = [(capacity, over // capacity)] + [(1 << b, over % capacity >> b & 1) for b in range(capacity.bit_length())]
    for tokens, times in new:
        if times:
            gaps.append((-tokens, sequence, times, 0))
            sequence += times
    return done + fill(gaps, free)


def fill(gaps: list[tuple[int, int, int, int]], free: list[Run]) -> list[Run]:
    """Places for all of ``free``, which has as many tokens as ``gaps``: the widest gap first takes the longest run
    that fits whole; where none does, the shortest that does not is cut."""
    heapq.heapify(gaps)
    by_left = [(run.left, i) for i, run in enumerate(free)]
    by_left.sort()
    runs, done = dict(enumerate(free)), []

    def keep(run: Run) -> None:
        if run.left:
            runs[len(runs)] = run
            insort(by_left, (run.left, len(runs) - 1))
        else:
            done.append(run)

    while gaps:
        minus, sequence, times, offset = heapq.heappop(gaps)
        tokens = -minus
        at = bisect_right(by_left, (tokens, len(runs)))
        run = runs[by_left.pop(at - 1 if at else 0)[1]]
        part = min(tokens, run.left)
        k = min(run.left // part, times)                                # parts of one piece, each for another gap
        u = min(run.count, times // k)
        if u < run.count:
            keep(run.split(u))
        run.put(part, k, sequence, offset)
        keep(run)
        if part < tokens:
            heapq.heappush(gaps, (part - tokens, sequence, u * k, offset + part))
        if u * k < times:
            heapq.heappush(gaps, (minus, sequence + u * k, times - u * k, offset))
    return done


class Places:
    """The runs of a plan as arrays: (length, rank) of a piece -> its parts."""

    def __init__(self, runs: list[Run]):
        runs = sorted(runs, key=lambda run: (run.length, run.first))
        self.mark = np.array([run.length << 44 | run.first for run in runs], np.int64)
        self.first = np.array([run.first for run in runs], np.int64)
        self.end = np.cumsum([len(run.places) for run in runs])
        self.places = np.array([p for run in runs for p in run.places], np.int64).reshape(-1, 5)

    def parts(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start within the piece, length, sequence, offset) of every part of every piece."""
        run = np.searchsorted(self.mark, length << 44 | rank, side="right") - 1
        n = self.end[run] - np.where(run > 0, self.end[run - 1], 0)
        row = np.repeat(np.arange(len(run)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start, part, k, sequence, offset = self.places[np.repeat(self.end[run] - n, n) + nth].T
        sequence = sequence + (rank - self.first[run])[row] * k
        j = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        rep = lambda a: np.repeat(a, k)
        return rep(row), rep(start) + j * rep(part), rep(part), rep(sequence) + j, rep(offset)


# --- on the cluster ------------------------------------------------------------------------------------------------

def whole_pieces(docs: DataFrame, capacity: int, end_id: int, doc_id: str, text: str, make_encoder: Callable,
                 width: str) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids_crc32, ids): the document, or full pieces after a shorter first one."""
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType)] + T._parse_datatype_string(
        "doc_tokens long, start long, length long, ids_crc32 long, ids binary").fields

    def setup():
        encode = make_encoder()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, out = [], []
            for i, t in enumerate(texts(batch.column("text"))):
                found = np.append(encode(t), np.uint32(end_id)).astype("<u4")
                for s, k in piece_bounds(len(found), capacity):
                    part = found[s:s + k]
                    row.append(i)
                    out.append((len(found), s, k, zlib.crc32(part), part.astype(width).tobytes()))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds))],
                names=[f.name for f in fields])
        return one

    return map_slices(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None, T.StructType(fields), setup)


def pack_cutting_stock(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, grid: int = GRID,
                       doc_id: str = "doc_id", text: str = "text", make_encoder: Callable = encoder,
                       width: str = "<u2") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) for every piece of every row.

    ``width`` holds the vocabulary's ids (``ids`` come in it; checksums are those of ``<u4``). Null and empty texts are
    the end id alone. Repeated rows are packed as often as they come; a null doc_id stays null. Other columns of ``docs``
    are ignored. An empty table gives no rows. A document longer than the capacity is first cut into full pieces and a
    shorter first one, so no task holds more of it than its text.
    """
    pieces = materialize(whole_pieces(docs, capacity, end_id, doc_id, text, make_encoder, width), "stock-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}   # at most ``capacity`` rows
    places = Places(plan(counts, capacity, grid))
    source = ranked(pieces, ["doc_id", "start", "ids_crc32"], per_group=10_000)
    fields = [source.schema["doc_id"]] + T._parse_datatype_string(
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary").fields

    def place(batches):
        for batch in batches:
            get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            whole = get("length")
            row, start, length, sequence, offset = places.parts(whole, get("rank"))
            crc, ids = get("ids_crc32")[row], batch.column("ids").take(pa.array(row))
            cut = np.flatnonzero(length != whole[row])
            if len(cut):
                parts = ids.to_pylist()
                for i in cut:
                    part = np.frombuffer(parts[i], width)[start[i]:start[i] + length[i]]
                    parts[i], crc[i] = part.tobytes(), zlib.crc32(part.astype("<u4"))
                ids = pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), *map(pa.array, (get("start")[row] + start, length, crc, get("doc_tokens")[row], sequence, offset)), ids],
                names=[f.name for f in fields])

    return source.mapInArrow(place, T.StructType(fields))


def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2,048 tokens."""
    return pack_cutting_stock(table(spark, sf_dir, "documents")).drop("ids")
