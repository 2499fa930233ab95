"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

Tokens of both sides that end at the same byte close a group. A text is tokenized in parts that meet at a single space
between two other characters, where neither tokenizer joins what stands on both sides; parts of long texts go to other
tasks. There their tokens are dealt into byte ranges, and each range is a fragment: tokens up to its first common end (the
open prefix, which closes a group begun before), closed groups, and tokens after its last one (the open suffix).
Fragments form a monoid: two neighbours compose into one, the suffix of the first and the prefix of the second into a
closed group where both have a common end. The open ends of a document's fragments are reduced in a tree, ``FAN``
neighbours of a level in one task; closed groups stay where they are.

The rows of the corpus come in chunks of about ``CHUNK`` bytes. A chunk keeps its documents' pairs as numbers of its own
list of pairs, so the shuffles carry one row per chunk and distinct pair: counts are summed per pair, the highest count of
each A id is found, and what a chunk looked up comes back to it in one row.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import table
from flatwatch.llm.token_pieces import JSON, RANKS, encoder
from flatwatch.session import materialize

PIECES = "piece_bpe_32k.model"

#: Characters of a part, bytes of a fragment, fragments that a task composes, bytes and texts of a chunk.
PART, RANGE, FAN, CHUNK, CHUNK_ROWS = 1 << 16, 1 << 16, 32, 1 << 20, 4096

Ids = np.ndarray


class Tokenizers:
    """Ids of a text (a space before it) by a byte-level BPE and a piece model, with the bytes of each id."""

    def __init__(self, ranks: str = RANKS, json: str = JSON, pieces: str = PIECES):
        import sentencepiece

        self.a = encoder(ranks, json)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        with open(public_tokenizers.path(ranks), "rb") as f:
            sizes = {int(i): len(base64.b64decode(token)) for token, i in map(bytes.split, f)}
        self.size_a = np.zeros(max(sizes) + 1, np.int64)
        self.size_a[list(sizes)] = list(sizes.values())
        self.bytes_b = [self._bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_b = np.array([len(x) for x in self.bytes_b])

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[Ids, Ids] | None]:
        """None where the text is empty or a side's bytes differ from the space and the text."""
        out: list[tuple[Ids, Ids] | None] = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            whole = (" " + text).encode()
            if not text or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                out.append(None)
                continue
            a = self.a(" " + text).astype(np.int64)
            out.append((a, np.array(b, np.int64)) if self.size_a[a].sum() == len(whole) else None)
        return out


@functools.cache
def tokenizers_here() -> Tokenizers:
    """One per Python worker, which runs many tasks."""
    return Tokenizers()


def parts(text: str, size: int) -> list[str]:
    """``text`` cut at single spaces between two other characters (which go), each part of ``size`` characters or as few
    more as needed. Each is tokenized with a space before it, just like that part of the whole text."""
    out, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at >= 0 and (text[at - 1].isspace() or at + 1 >= len(text) or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at + 1
    return [*out, text[start:]]


# --- the monoid ----------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Fragment:
    """The open ends of a byte range. Without a common end (``first`` < 0) all tokens are its prefix."""

    prefix: tuple[Ids, Ids]
    suffix: tuple[Ids, Ids]
    first: int = -1                                  # start of the range that has the first common end

    def then(self, after: Fragment) -> tuple[Fragment, tuple[int, Ids, Ids] | None]:
        """The fragment of both, and the group that their meeting closes: (range, A ids, B ids)."""
        join = lambda x, y: (np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]))
        if self.first < 0:
            return Fragment(join(self.prefix, after.prefix), after.suffix, after.first), None
        if after.first < 0:
            return Fragment(self.prefix, join(self.suffix, after.prefix), self.first), None
        group = join(self.suffix, after.prefix)
        return Fragment(self.prefix, after.suffix, self.first), (after.first, *group) if len(group[0]) or len(group[1]) else None


def common_ends(ends_a: Ids, ends_b: Ids) -> tuple[Ids, Ids]:
    """Numbers of the tokens of both sides that end at a common byte."""
    if not len(ends_a) or not len(ends_b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
    hit = np.flatnonzero(ends_b[at] == ends_a)
    return hit, at[hit]


def fragments(a: Ids, b: Ids, ends_a: Ids, ends_b: Ids, size: int) -> Iterator[tuple[int, Fragment, Ids, Ids, Ids, Ids]]:
    """(start, open ends, A ids, B ids, A and B sizes of the closed groups) per range of ``size`` bytes with a token end."""
    for n in np.union1d((ends_a - 1) // size, (ends_b - 1) // size):
        lo, hi = n * size + 1, (n + 1) * size + 1
        ra = slice(*np.searchsorted(ends_a, (lo, hi)))
        rb = slice(*np.searchsorted(ends_b, (lo, hi)))
        x, y, start = a[ra], b[rb], int(n * size)
        ia, ib = common_ends(ends_a[ra], ends_b[rb])
        if not len(ia):
            yield start, Fragment((x, y), (x[:0], y[:0])), x[:0], y[:0], x[:0], y[:0]
            continue
        open_ = Fragment((x[:ia[0] + 1], y[:ib[0] + 1]), (x[ia[-1] + 1:], y[ib[-1] + 1:]), start)
        yield start, open_, x[ia[0] + 1:ia[-1] + 1], y[ib[0] + 1:ib[-1] + 1], np.diff(ia), np.diff(ib)


# --- groups of a chunk of units ------------------------------------------------------------------------------------

def starts(sizes: Ids) -> Ids:
    return np.cumsum(sizes) - sizes


def within(sizes: Ids) -> Ids:
    """0, 1, .. of each run of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(starts(sizes), sizes)


def render(a: Ids, b: Ids, ga: Ids, gb: Ids, text_a: tuple, text_b: tuple) -> np.ndarray:
    """The texts of all tokens in the order of the digest, each with what follows it; the last ends with ``;``."""
    out = np.empty(len(a) + len(b), object)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[np.cumsum(ga) - 1] = True
    last_b[np.cumsum(gb) - 1] = True
    for ids, last, texts, place in ((a, last_a, text_a, np.arange(len(a)) + np.repeat(starts(gb), ga)),
                                    (b, last_b, text_b, np.arange(len(b)) + np.repeat(np.cumsum(ga), gb))):
        out[place] = np.where(last, texts[1][ids], texts[0][ids])
    return out


@functools.cache
def texts_of(n: int, end: bytes) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([b"%d%s" % (i, mark) for i in range(n)], object) for mark in (b",", end))


def linked(a: Ids, b: Ids, ga: Ids, gb: Ids, unit: Ids) -> tuple[Ids, Ids, Ids]:
    """(unit, pair, times) of the distinct pairs A id << 16 | B id linked in each unit. ``unit``: that of each group."""
    wide = ga * gb > 4096                            # there, distinct ids with their times instead of all occurrences
    ua, ub = starts(ga), starts(gb)
    found = []
    for g in np.flatnonzero(wide):
        (ia, na), (ib, nb) = (np.unique(x[s:s + n], return_counts=True) for x, s, n in ((a, ua[g], ga[g]), (b, ub[g], gb[g])))
        found.append((np.full(len(ia) * len(ib), unit[g]), (ia[:, None] << 16 | ib).ravel(), np.multiply.outer(na, nb).ravel()))
    n = np.where(wide, 0, gb)
    each = np.repeat(n, ga)                          # partners of every A token
    group = np.repeat(np.repeat(np.arange(len(ga)), ga), each)
    pair = np.repeat(a, each) << 16 | b[ub[group] + within(each)]
    found.append((unit[group], pair, np.ones(len(pair), np.int64)))
    u, pair, times = (np.concatenate(x) for x in zip(*found))
    key, at = np.unique(u << 32 | pair, return_inverse=True)
    return key >> 32, key & 0xFFFFFFFF, np.bincount(at, weights=times, minlength=len(key)).astype(np.int64)


CHUNK_SCHEMA = ("chunk long, rid array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
                "digest array<string>, pairs array<long>, docs array<long>, per_unit binary, pair binary, times binary")


def chunk_row(number: int, doc_ids: pa.Array, rid: list, a: Ids, b: Ids, ga: Ids, gb: Ids, per_unit: Ids, digests: list,
              names: list[str]) -> pa.RecordBatch:
    """One row: the units' counts, the chunk's distinct pairs (with the units that hold each), and each unit's pairs."""
    unit = np.repeat(np.arange(len(per_unit)), per_unit)
    count = lambda x: np.bincount(unit, weights=x, minlength=len(per_unit)).astype(np.int64)
    u, pair, times = linked(a, b, ga, gb, unit)
    pairs, at, docs = np.unique(pair, return_inverse=True, return_counts=True)
    values = [number, rid, *map(np.ndarray.tolist, (count(ga), count(gb), per_unit, count(ga * gb))), digests, pairs.tolist(),
              docs.tolist(), np.bincount(u, minlength=len(per_unit)).astype("<u4").tobytes(), at.astype("<u4").tobytes(),
              times.astype("<u4" if not len(times) or times.max() < 1 << 32 else "<u8").tobytes()]
    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids), *(pa.array([v], k) for v, k in zip(values, kinds))],
        names=names)


def gathered(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], Ids]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``CHUNK`` bytes, in order."""
    held, total = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.cumsum(size(batch))
        start = 0
        for i in range(batch.num_rows):
            rows = sum(x.num_rows for x in held) + i + 1 - start
            if total + cuts[i] - (cuts[start - 1] if start else 0) >= CHUNK or rows >= CHUNK_ROWS:
                yield pa.concat_batches([*held, batch.slice(start, i + 1 - start)])
                held, total, start = [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
            total += int(cuts[-1] - (cuts[start - 1] if start else 0))
    if held:
        yield pa.concat_batches(held)


def chunk_schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_ids", T.ArrayType(doc_id)), *T._parse_datatype_string(CHUNK_SCHEMA).fields])


def short_chunks(docs: DataFrame, make: Callable[[], Tokenizers]) -> DataFrame:
    """Chunks of whole texts (doc_id, text), tokenized and aligned where they are read."""
    schema = chunk_schema(docs.schema["doc_id"].dataType)

    def run(batches):
        tokenizers = make()
        text_a, text_b = texts_of(len(tokenizers.size_a), b"|"), texts_of(len(tokenizers.size_b), b";")
        none = np.zeros(0, np.int64)
        lengths = lambda batch: np.array([len(t) if t else 0 for t in batch.column("text").to_pylist()])
        for n, batch in enumerate(gathered(batches, lengths)):
            tokens = [t or (none, none) for t in tokenizers.encode([t or "" for t in batch.column("text").to_pylist()])]
            a, b = (np.concatenate([t[i] for t in tokens]) for i in (0, 1))
            ends_a, ends_b = np.cumsum(tokenizers.size_a[a]), np.cumsum(tokenizers.size_b[b])
            ia, ib = common_ends(ends_a, ends_b)
            ga, gb = np.diff(ia, prepend=-1), np.diff(ib, prepend=-1)
            upto = np.searchsorted(ia, np.cumsum([len(t[0]) for t in tokens]) - 1, side="right")
            order = render(a, b, ga, gb, text_a, text_b)
            at = np.cumsum([len(x) + len(y) for x, y in tokens])
            digests = [hashlib.sha256(b"".join(order[e - len(x) - len(y):e].tolist())[:-1]).hexdigest() if len(x) else ""
                       for e, (x, y) in zip(at, tokens)]
            yield chunk_row(TaskContext.get().partitionId() << 32 | n, batch.column("doc_id"), [None] * batch.num_rows,
                            a, b, ga, gb, np.diff(upto, prepend=0), digests, schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- long texts ----------------------------------------------------------------------------------------------------

UNIT = "a binary, b binary, ga binary, gb binary"    # ids as <u2, sizes of groups as <u4
ENDS = "pa binary, pb binary, sa binary, sb binary, first long"


def long_fragments(docs: DataFrame, make: Callable[[], Tokenizers]) -> DataFrame:
    """(rid, start, valid, open ends, closed groups) of the byte ranges of long texts (rid, text)."""
    def cut(batches):
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                at = 0
                for part in parts(text, PART):
                    yield pa.RecordBatch.from_pydict({"rid": [rid], "at": [at], "part": [part]})
                    at += len(part.encode()) + 1

    def run(batches):
        tokenizers = make()
        for batch in batches:
            for rid, at, part in zip(*(c.to_pylist() for c in batch.columns)):
                found = tokenizers.encode([part])[0]
                rows = []
                if found:
                    a, b = found
                    ends = at + np.cumsum(tokenizers.size_a[a]), at + np.cumsum(tokenizers.size_b[b])
                    for start, f, x, y, ga, gb in fragments(a, b, *ends, RANGE):
                        ids = [z.astype("<u2").tobytes() for z in (*f.prefix, *f.suffix, x, y)]
                        rows.append((rid, max(start, at), True, *ids[:4], max(start, at) if f.first >= 0 else -1, *ids[4:],
                                     *(g.astype("<u4").tobytes() for g in (ga, gb))))
                else:
                    rows.append((rid, at, False, *[b""] * 4, -1, *[b""] * 4))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    schema = f"rid long, start long, valid boolean, {ENDS}, {UNIT}"
    names = T._parse_datatype_string(schema).names
    # rid tells rows apart that are equal; parts go to any task.
    return (docs.mapInArrow(cut, "rid long, at long, part string").repartition("rid", "at").mapInArrow(run, schema))


def reduced(found: DataFrame) -> DataFrame:
    """(rid, start, a, b): the groups that fragments of a document close between them, by a tree of compositions."""
    top = found.agg(F.max("start")).first()[0]
    names = ["rid", "start", "pa", "pb", "sa", "sb", "first", "closes"]
    schema = f"rid long, start long, {ENDS}, closes boolean"
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.bool_()]

    def level(span: int) -> Callable:
        def run(batches):
            held = None                              # (rid, group, start, fragment)

            def out(rows: list) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 8, kinds)], names=names)

            def row(rid: int, _, start: int, f: Fragment) -> tuple:
                return rid, start, *(z.tobytes() for z in (*f.prefix, *f.suffix)), f.first, False

            for batch in batches:
                rows = []
                for rid, start, *ids, first in zip(*(batch.column(n).to_pylist() for n in names[:7])):
                    x = [np.frombuffer(z, "<u2") for z in ids]
                    f = Fragment((x[0], x[1]), (x[2], x[3]), first)
                    if held and held[:2] == (rid, start // span):
                        both, group = held[3].then(f)
                        held = (*held[:3], both)
                        if group:
                            rows.append((rid, group[0], group[1].tobytes(), group[2].tobytes(), b"", b"", 0, True))
                    else:
                        if held:
                            rows.append(row(*held))
                        held = (rid, start // span, start, f)
                yield out(rows)
            if held:
                yield out([row(*held)])
        return run

    live, span, closed = found.select(*names[:7]), RANGE, []
    while True:
        span *= FAN
        live = materialize(live.repartition("rid", F.floor(F.col("start") / span)).sortWithinPartitions("rid", "start")
                           .mapInArrow(level(span), schema), "align-level")
        closed.append(live.filter("closes"))
        live = live.filter("not closes").drop("closes")
        if top is None or span > top:
            break
    # A document begins at a common end: what its first closing range completes is a group. Its end is one as well.
    groups = live.filter("first >= 0").select("rid", F.col("first").alias("start"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    for part in closed:
        groups = groups.unionByName(part.select("rid", "start", F.col("pa").alias("a"), F.col("pb").alias("b")))
    return groups


def long_units(docs: DataFrame, make: Callable[[], Tokenizers]) -> tuple[DataFrame, DataFrame]:
    """(rid of every long text, valid; its groups: rid, start, kind, a, b, ga, gb). Ranges come as units in their order."""
    found = materialize(long_fragments(docs, make), "align-fragments")
    valid = found.groupBy("rid").agg(F.min("valid").alias("valid"))
    found = found.join(valid.filter("valid").select("rid"), "rid")
    four = lambda c: F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright(F.octet_length(c) / 2, 8 * i).bitwiseAND(F.lit(255))), 2, "0")
                                        for i in range(4)]))
    seams = reduced(found).select("rid", "start", F.lit(0).alias("kind"), "a", "b", *[
        four(F.col(c)).alias("g" + c) for c in "ab"])
    closed = found.filter(F.octet_length("ga") > 0).select("rid", "start", F.lit(1).alias("kind"), "a", "b", "ga", "gb")
    return valid, materialize(seams.unionByName(closed), "align-units")


def long_chunks(units: DataFrame) -> DataFrame:
    """Chunks of units of long texts; the document's number is its rid."""
    schema = chunk_schema(T.LongType())

    def run(batches):
        for n, batch in enumerate(gathered(batches, lambda x: np.array([4 * len(a) for a in x.column("a").to_pylist()]))):
            get = lambda name, kind: [np.frombuffer(x, kind).astype(np.int64) for x in batch.column(name).to_pylist()]
            ga, gb = get("ga", "<u4"), get("gb", "<u4")
            rid = batch.column("rid")
            yield chunk_row(1 << 62 | TaskContext.get().partitionId() << 32 | n, rid, rid.to_pylist(), *map(np.concatenate, (
                get("a", "<u2"), get("b", "<u2"), ga, gb)), np.array([len(g) for g in ga]), [None] * batch.num_rows, schema.names)

    return units.mapInArrow(run, schema)


def long_digests(units: DataFrame, make: Callable[[], Tokenizers]) -> DataFrame:
    """(rid, digest): units of a document streamed in order."""
    def run(batches):
        tokenizers = make()
        text_a, text_b = texts_of(len(tokenizers.size_a), b"|"), texts_of(len(tokenizers.size_b), b";")
        now, state = None, None
        done = lambda: pa.RecordBatch.from_pydict({"rid": [now], "digest": [state.hexdigest()]})
        for batch in batches:
            for rid, *parts_ in zip(*(batch.column(n).to_pylist() for n in ("rid", "a", "b", "ga", "gb"))):
                a, b, ga, gb = (np.frombuffer(x, k).astype(np.int64) for x, k in zip(parts_, ("<u2", "<u2", "<u4", "<u4")))
                piece = b"".join(render(a, b, ga, gb, text_a, text_b).tolist())[:-1]
                if rid != now:
                    if state:
                        yield done()
                    now, state = rid, hashlib.sha256(piece)
                else:
                    state.update(b";" + piece)
        if state:
            yield done()

    return (units.repartition("rid").sortWithinPartitions("rid", "start", "kind").drop("start", "kind")
            .mapInArrow(run, "rid long, digest string"))


# --- counts --------------------------------------------------------------------------------------------------------

def scored(chunks: DataFrame, looked_up: DataFrame, doc_id: T.DataType) -> DataFrame:
    """A row per unit, with its links of the highest count and the sum of counts."""
    fields = [T.StructField("doc_id", doc_id), *T._parse_datatype_string(
        "rid long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string").fields]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                counts, best = (np.array(row[n].as_py() or [], np.int64) for n in ("counts", "best"))
                n = np.frombuffer(row["per_unit"].as_py(), "<u4").astype(np.int64)
                pair = np.frombuffer(row["pair"].as_py(), "<u4")
                times = row["times"].as_py()
                times = np.frombuffer(times, "<u4" if len(times) == 4 * len(pair) else "<u8").astype(np.int64)
                total = lambda x: np.diff(np.append(0, np.cumsum(x))[np.append(0, np.cumsum(n))])
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, *(row[c].values for c in ("rid", "n_a", "n_b", "n_groups", "n_links")),
                     pa.array(total(times * best[pair])), pa.array(total(times * counts[pair])), row["digest"].values],
                    names=[f.name for f in fields])

    looked_up = looked_up.withColumnRenamed("chunk", "of")
    return (chunks.drop("pairs", "docs").join(looked_up, F.col("chunk") == F.col("of"), "left").drop("chunk", "of")
            .mapInArrow(run, T.StructType(fields)))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", make: Callable[[], Tokenizers] = tokenizers_here) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    Null and empty texts, and those whose tokens do not spell the space and the text, have zeros and an empty digest, and
    count in no pair. Repeated rows are documents of their own; a null doc_id stays null; other columns are ignored. An
    empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType
    is_long = F.coalesce(F.length("text") > PART, F.lit(False))
    short = materialize(short_chunks(docs.filter(~is_long), make), "align-short")
    long_docs = materialize(docs.filter(is_long).withColumn("rid", F.monotonically_increasing_id()), "align-long")
    valid, units = long_units(long_docs.select("rid", "text"), make)
    long_ = materialize(long_chunks(units), "align-long-chunks")

    listed = short.select("chunk", "pairs", "docs").unionByName(long_.select("chunk", "pairs", F.lit(None).cast("array<long>").alias("docs")))
    held = listed.select("chunk", F.posexplode("pairs").alias("at", "pair"), "docs").select(
        "chunk", "pair", F.coalesce(F.get("docs", F.col("at")), F.lit(0).cast("long")).alias("n"))
    # The pairs of a long text lie in several units; it counts once.
    of_long = (pairs_of_units(long_).distinct().groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    counts = materialize(held.select("pair", "n").unionByName(of_long).groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    a = F.shiftright("pair", 16)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    ranked = counts.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    looked_up = (held.select("chunk", "pair").join(ranked, "pair").groupBy("chunk")
                 .agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("found"))       # a chunk's pairs
                 .select("chunk", F.col("found.n").alias("counts"), F.col("found.best").alias("best")))
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = scored(short, looked_up, kind).select("doc_id", *sums, F.col("digest").alias("groups_sha256"))
    totals = scored(long_, looked_up, T.LongType()).groupBy("rid").agg(*[F.sum(c).alias(c) for c in sums])
    of_long_docs = (long_docs.select("rid", "doc_id").join(totals, "rid", "left").join(long_digests(units, make), "rid", "left")
                    .select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums],
                            F.coalesce("digest", F.lit("")).alias("groups_sha256")))
    return out.unionByName(of_long_docs)


def pairs_of_units(chunks: DataFrame) -> DataFrame:
    """(rid, pair) of units of long texts."""
    def run(batches):
        for batch in batches:
            for rid, pairs, per_unit, pair in zip(*(batch.column(n).to_pylist() for n in ("rid", "pairs", "per_unit", "pair"))):
                n = np.frombuffer(per_unit, "<u4")
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(rid, np.int64), n)), pa.array(
                    np.array(pairs, np.int64)[np.frombuffer(pair, "<u4")])], names=["rid", "pair"])

    return chunks.select("rid", "pairs", "per_unit", "pair").mapInArrow(run, "rid long, pair long")


def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the byte-level and the piece vocabulary."""
    return align(table(spark, sf_dir, "documents"))
