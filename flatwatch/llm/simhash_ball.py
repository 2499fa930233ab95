"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``2 r`` bits exactly if some 64-bit value lies within ``r`` bits of both.
Every distinct fingerprint therefore emits its variants within ``r`` bits, the variants are dealt out by value, and
fingerprints that meet in a variant are linked. Everything that meets in one variant is pairwise within ``2 r`` bits
(triangle inequality), so a chain through the fingerprints of a variant keeps every link: the edges grow with the
number of fingerprints, not with its square, whatever the size of a group of copies.

A fingerprint has 2,081 variants of two bits or fewer. They are not shuffled one by one: a row for each variant of
the first 16 bits (137 of them) travels with the fingerprint and the number of bits already used, and the task that
owns those 16 bits unfolds the remaining bits in memory. Buckets of 16 bits that would hold more than ``hot_rows``
rows -- known beforehand from a histogram of 65,536 counts -- are dealt out by 32 bits instead, and a task that still
meets a large bucket splits it by the next bits, so a task's memory is bounded for any distribution.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatwatch.llm.common import each_salt, map_slices, popcount, row_key, salted, salts_seen, table, utf8
from flatwatch.llm.components import connected_components
from flatwatch.session import materialize

#: Rows of one bucket that a task unfolds at once: a row's number there takes the low 16 bits of a sort key.
UNFOLD_ROWS = 1 << 16
BLOCK = 1 << 16


def shingle_hashes(raw: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words (A-Z lower-cased, joined by one space, repeats included)."""
    parts = raw.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(b" ".join(parts), seed)], np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(parts) - words + 1
    return np.fromiter((digest(line[s:e], seed) for s, e in zip(starts[:count].tolist(), ends[words - 1:].tolist())),
                       np.uint64, count)


def fingerprint(raw: bytes, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash: a bit is one if more than half of the shingle hashes set it. No words: zero."""
    hashes = shingle_hashes(raw, words, seed)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = hashes[start:start + BLOCK].astype("<u8", copy=False)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, text: str = "text") -> DataFrame:
    """``docs`` columns but the text, plus ``fp`` (long: the 64 bits as two's complement). Null text has no words."""
    keep = [c for c in docs.columns if c not in (text, "fp")]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x, words, seed) for x in utf8(batch.column(text))], np.uint64)
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    schema = docs.select(*keep).schema
    return map_slices(docs.select(*keep, text), one, schema.add("fp", "long"))


def masks(bits: int, radius: int) -> np.ndarray:
    """All masks of ``bits`` bits with at most ``radius`` ones."""
    return np.array([sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(bits), k)], np.uint64)


def meet(low: np.ndarray, used: np.ndarray, bits: int, radius: int) -> np.ndarray:
    """Index pairs that meet: ``low`` are the last ``bits`` bits, ``used`` the bits changed before them.

    Rows that share a variant are chained in order of their index. Rows of more than ``UNFOLD_ROWS`` are split by
    the next eight bits of the variant first, which bounds memory.
    """
    if len(low) < 2:
        return np.empty((0, 2), np.int64)
    if len(low) > UNFOLD_ROWS or bits > 48:
        if bits == 0:                                   # one variant: every row meets every other
            order = np.arange(len(low))
            return np.stack([order[:-1], order[1:]], 1)
        cut = min(8, bits)
        head = (low >> np.uint64(bits - cut)).astype(np.int64)
        rest = low & np.uint64((1 << (bits - cut)) - 1)
        found = []
        for value in range(1 << cut):
            spent = used + popcount(head ^ value).astype(used.dtype)
            at = np.flatnonzero(spent <= radius)
            if len(at) > 1:
                found.append(at[meet(rest[at], spent[at], bits - cut, radius)])
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
    variants = []
    for left in range(radius + 1):
        at = np.flatnonzero(used == radius - left)
        if len(at):
            ball = masks_of(bits, left)
            variants.append(((low[at][:, None] ^ ball[None, :]) << np.uint64(16) | at.astype(np.uint64)[:, None]).ravel())
    keys = np.sort(np.concatenate(variants))
    same = np.flatnonzero((keys[1:] >> np.uint64(16)) == (keys[:-1] >> np.uint64(16)))
    if not len(same):
        return np.empty((0, 2), np.int64)
    index = np.uint64(0xFFFF)
    pairs = np.unique((keys[same] & index) << np.uint64(16) | (keys[same + 1] & index))
    return np.stack([(pairs >> np.uint64(16)).astype(np.int64), (pairs & index).astype(np.int64)], 1)


_MASKS: dict[tuple[int, int], np.ndarray] = {}


def masks_of(bits: int, radius: int) -> np.ndarray:
    if (bits, radius) not in _MASKS:
        _MASKS[bits, radius] = masks(bits, radius)
    return _MASKS[bits, radius]


def collide(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b) fingerprints that meet, from rows (p, q, used, fp) sorted by (p, q) within partitions.

    ``p``: a variant's first 16 bits; ``q``: its next 16 bits, or -1 where the bucket was not dealt out by them.
    """

    def bucket(q: int, used: np.ndarray, fp: np.ndarray) -> np.ndarray:
        order = np.argsort(fp, kind="stable")
        used, fp = used[order], fp[order]
        bits = 48 if q < 0 else 32
        pairs = meet(fp & np.uint64((1 << bits) - 1), used, bits, radius)
        return fp[pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            cols[3] = cols[3].view(np.uint64)
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            ends = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])) + 1
            if not len(ends):
                continue
            yield edges(held, np.concatenate(([0], ends)))
            held = [x[ends[-1]:] for x in held]
        if held is not None and len(held[0]):
            yield edges(held, np.array([0, len(held[0])]))

    def edges(held: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
        found = [bucket(int(held[1][s]), held[2][s:e], held[3][s:e])
                 for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if e - s > 1]
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def ball_rows(fps: DataFrame, radius: int, hot_rows: int) -> DataFrame:
    """(p, q, used, fp) for every variant of the first 16 bits; 32 bits where a bucket is hot."""
    spark = fps.sparkSession
    head = F.shiftrightunsigned("fp", 48).cast("int")
    counts = np.zeros(1 << 16, np.int64)
    for r in fps.groupBy(head.alias("p")).count().collect():        # at most 65,536 rows by construction
        counts[r["p"]] = r["count"]
    changes = masks(16, radius).astype(np.int64)
    arrivals = sum(counts[np.arange(1 << 16) ^ m] for m in changes)
    hot = np.flatnonzero(arrivals > hot_rows).tolist()
    ball = F.array(*[F.lit(int(m) | bin(m).count("1") << 16) for m in changes])
    rows = (fps.select("fp", head.alias("h"), F.explode(ball).alias("m"))
            .select("fp", F.col("h").bitwiseXOR(F.col("m").bitwiseAND(F.lit(0xFFFF))).alias("p"),
                    F.shiftright("m", 16).alias("used")))
    if not hot:
        return rows.select("p", F.lit(-1).alias("q"), "used", "fp")
    hot_df = F.broadcast(spark.createDataFrame([(p, True) for p in hot], "p int, hot boolean"))   # at most 65,536 rows
    nothing = F.array(F.lit(-1))
    wide = (rows.join(hot_df, "p", "left")
            .select("p", "used", "fp", F.explode(F.when(F.col("hot"), ball).otherwise(nothing)).alias("m")))
    second = F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit(0xFFFF).cast("long")).cast("int")
    return (wide.select("p", F.when(F.col("m") < 0, F.lit(-1)).otherwise(second.bitwiseXOR(F.col("m").bitwiseAND(F.lit(0xFFFF)))).alias("q"),
                        (F.col("used") + F.when(F.col("m") < 0, F.lit(0)).otherwise(F.shiftright("m", 16))).alias("used"), "fp")
            .filter(F.col("used") <= radius))


def links(fps: DataFrame, max_bits: int = 4, hot_rows: int = 50_000) -> DataFrame:
    """(a, b): links between distinct fingerprints of ``fps`` whose closure is that of all links of ``max_bits`` or fewer.

    Every returned pair is verified; pairs of one variant are chained, not listed all against all.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: the balls of half the radius then meet exactly")
    rows = ball_rows(fps, max_bits // 2, hot_rows)
    dealt = rows.repartition(F.col("p"), F.col("q")).sortWithinPartitions("p", "q")
    return collide(dealt, max_bits // 2).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, seed: int = 42, doc_id: str = "doc_id",
                    text: str = "text", hot_rows: int = 50_000) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; ``component_id`` is the smallest linked doc_id.

    Null or empty texts have fingerprint zero and are linked like any other. A null doc_id gets a fingerprint and
    component, and never names one unless all ids of the component are null. Repeated rows are returned as often as
    they come; the copies of one text meet their component dealt out by salts. An empty table gives no rows; other
    columns are ignored, so their names can't clash.
    """
    fps = materialize(salted(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words, seed)),
                      "simhash-fp")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), salts_seen().alias("__salts")), "simhash-nodes")
    named = connected_components(materialize(links(nodes.select("fp"), max_bits, hot_rows), "simhash-links"))
    of_root = (named.join(nodes, named["node"] == nodes["fp"]).groupBy("root").agg(F.min("least").alias("component_id")))
    of_node = named.join(of_root, "root").select(F.col("node").alias("fp"), "component_id")
    linked = (nodes.join(of_node, "fp", "left")
              .select("fp", F.coalesce("component_id", "least").alias("component_id"), each_salt(F.col("__salts")).alias("__salt")))
    return fps.join(linked, ["fp", "__salt"], "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row per group of near copies: the one with the smallest doc_id (and smallest row hash among equals).

    Rows without an id stay only if no row of their group has one; of rows equal in id and text one stays. A row is known
    by 128 bits of its id and text.
    """
    keyed = docs.withColumn("__row", F.struct(row_key(doc_id, text).alias("high"),
                                              F.xxhash64(F.lit("low"), F.col(doc_id), F.col(text)).alias("low")))
    found = near_duplicates(keyed.select(F.struct(F.col(doc_id).isNull(), F.col(doc_id), "__row").alias("doc_id"),
                                         F.col(text).alias("text")), **options)
    kept = found.select(F.col("component_id.__row").alias("__row")).distinct()
    return keyed.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")


def op5_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: fingerprint in hex and smallest doc_id reachable over links of four bits or fewer."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
