"""Substring deduplication over sliding runs of sentences.

A text is cut into sentences; every run of several consecutive sentences is hashed; a run that occurs more than once
anywhere keeps its first occurrence, and the sentences that any later occurrence covers are removed.

A word is a stretch without white space; in scripts written without spaces each character is one. A word ends a sentence
if the punctuation after its last letter or digit (closing quotes and brackets included) holds a sentence end of any
script, or if a line break follows; ends beyond ASCII need no space after them. What goes on for more than ``LONGEST``
words without such an end is no sentence but a list, a table or text without punctuation. It is cut after the word of
least hash in any ``WINDOW`` words, so that a cut depends on the words around it alone: a passage in the middle of two
such stretches has the same cuts from its tenth word on, and holds whole runs. Commas cut sentences further, like the
semicolons and colons among the ends: a passage that begins and ends within the sentences around it may hold a single
whole one in fifty words, but holds whole clauses. What is called a sentence below is such a clause, if commas are there.
A run starts at every sentence and goes on until it has ``run`` sentences and ``min_words`` words; one more run ends with
the text, so that its last sentences belong to one. Runs are compared by 128 bits.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import map_slices, row_key, table, utf8
from flatwatch.session import materialize, release

# fixed values: sentence ends that need a space or the text's end after them, those that need none
ENDS = ".!?;:\u2026"
ENDS_ANYWHERE = ("\u3002\uff61\uff0e\uff01\uff1f\uff1b\uff1a\u037e\u0589\u061f\u061b\u06d4\u0964\u0965\u104a\u104b\u1362\u1367\u1368"
                 "\u17d4\u17d5\u0f0d\u0f0e\u1803\u1809\u203c\u203d\u2047\u2048\u2049")
# fixed values: commas that need a space or the text's end after them, those that need none
COMMAS = ","
COMMAS_ANYWHERE = "\u3001\uff64\uff0c\u060c\u060d\u055d\u07f8\u1363\u1364\u1365\u1802\u1808"
# fixed values: blocks of scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han)
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
            (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
SPACE, WORD, END, ANYWHERE, ALONE, COMMA = 1, 2, 4, 8, 16, 32
#: Most words of a sentence; of the pieces of what is longer.
LONGEST, WINDOW = 40, 10


@functools.cache
def classes() -> np.ndarray:
    """What each code point is, as bits."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M":
            out[c] = WORD
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    for first, last in UNSPACED:
        out[first:last + 1] |= np.where(out[first:last + 1] & WORD, np.uint8(ALONE), np.uint8(0))
    out[[ord(c) for c in ENDS]] = END
    out[[ord(c) for c in ENDS_ANYWHERE]] = END | ANYWHERE
    out[[ord(c) for c in COMMAS]] = COMMA
    out[[ord(c) for c in COMMAS_ANYWHERE]] = COMMA | ANYWHERE
    return out


def before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each position, the end included."""
    return np.concatenate(([0], np.cumsum(flags)))


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, stop, comma): byte offsets of the words, whether each one ends a sentence and has a comma."""
    if raw.isascii():
        points = np.frombuffer(raw, np.uint8)
        offset = None
    else:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        offset = np.concatenate(([0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))))
    kind = classes()[points]
    space = (kind & SPACE) > 0
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts = np.flatnonzero(edge == -1)
    letters = np.flatnonzero(kind & WORD)
    if offset is not None and (kind & (ALONE | ANYWHERE)).any():
        alone = (kind[letters] & ALONE) > 0
        wide = before((kind & ANYWHERE) > 0)[letters]
        fresh = alone | np.concatenate(([False], alone[:-1] | (wide[1:] > wide[:-1])))
        starts = np.union1d(starts, letters[fresh])
    if not len(starts):
        return starts, starts, np.empty(0, bool), np.empty(0, bool)
    after = np.append(starts[1:], len(points))
    blank = np.flatnonzero(edge == 1)                              # where white space begins, and the end
    ends = np.minimum(after, blank[np.searchsorted(blank, starts, side="right")])
    last = np.append(-1, letters)[np.searchsorted(letters, ends)]  # the last letter or digit before the word's end
    tail = np.maximum(last + 1, starts)
    marks, commas, lines = before((kind & END) > 0), before((kind & COMMA) > 0), before(points == 10)
    stop = (marks[ends] > marks[tail]) | (lines[after] > lines[ends])
    stop[-1] = True
    comma = commas[ends] > commas[tail]
    return (starts, ends, stop, comma) if offset is None else (offset[starts], offset[ends], stop, comma)


def sentences(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first words): byte offsets of the words and the index of each sentence's first word.

    A text without words has none of them.
    """
    starts, ends, stop, comma = words(raw)
    if not len(starts):
        return starts, ends, starts
    size = np.diff(np.concatenate(([-1], np.flatnonzero(stop))))
    if size.max() > LONGEST:
        low = np.frombuffer(raw, np.uint8).astype(np.uint64) | np.uint64(32)             # a letter's case makes no difference
        plain = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low)))
        placed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low * np.arange(len(low), dtype=np.uint64))))
        total = plain[ends] - plain[starts]
        mixed = (placed[ends] - placed[starts] - starts.astype(np.uint64) * total) * np.uint64(0x9E3779B97F4A7C15) + total
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.where(stop, np.uint64(0), (mixed ^ (mixed >> np.uint64(29))) | np.uint64(1))
        windows = np.lib.stride_tricks.sliding_window_view(order[::-1], WINDOW)
        least = len(starts) - 1 - (np.arange(len(windows)) + windows.argmin(axis=1))     # the last one of equal words
        stop[least[np.repeat(size > LONGEST, size)[least]]] = True
    stop |= comma
    return starts, ends, np.concatenate(([0], np.flatnonzero(stop[:-1]) + 1))


def runs(raw: bytes, run: int, min_words: int, units: tuple | None = None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(hash, first sentence, number of sentences) of every run in a text; words are compared A-Z lower-cased.

    ``units``: the text's :func:`sentences`, if at hand.
    """
    starts, ends, first = units or sentences(raw)
    bounds = np.append(first, len(starts))
    upto = np.maximum(np.arange(len(first)) + run, np.searchsorted(bounds, first + min_words))
    at = np.flatnonzero(upto <= len(first)) if len(first) else np.empty(0, np.int64)
    if not len(at):
        return [], at, at
    upto = upto[at]
    tail = min(len(first) - run, int(np.searchsorted(first, len(starts) - min_words, side="right")) - 1)
    if upto[-1] < len(first):
        at, upto = np.append(at, tail), np.append(upto, len(first))
    line = b" ".join(raw.lower().split())
    offset = np.concatenate(([0], np.cumsum(ends[:-1] - starts[:-1] + (starts[1:] > ends[:-1]))))
    end = offset + (ends - starts)
    digest = xxhash.xxh3_128_digest
    hashes = [digest(line[s:e]) for s, e in zip(offset[first[at]].tolist(), end[bounds[upto] - 1].tolist())]
    return hashes, at, upto - at


def halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes as two longs each."""
    both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def wholes(high: np.ndarray, low: np.ndarray) -> set[bytes]:
    """What :func:`halves` was given."""
    raw = np.stack((high, low), axis=1).tobytes()
    return {raw[i:i + 16] for i in range(0, len(raw), 16)}


def strip(raw: bytes, repeats: set[bytes], run: int, min_words: int) -> tuple[bytes, list[tuple[int, int]], int, int]:
    """The text without the sentences of runs that occur earlier in it or whose hash is in ``repeats``, the removed byte
    ranges, and the sentence counts (all, removed).

    A sentence takes the white space after it along.
    """
    units = sentences(raw)
    starts, _, first = units
    gone = np.zeros(len(first), bool)
    hashes, at, length = runs(raw, run, min_words, units)
    seen = set(repeats)
    for i, h in enumerate(hashes):
        if h in seen:
            gone[at[i]:at[i] + length[i]] = True
        seen.add(h)
    cut = np.append(starts[first], len(raw))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    ranges = [(int(cut[s]), int(cut[e])) for s, e in zip(edge[0::2], edge[1::2])]
    kept, end = [], 0
    for s, e in ranges:
        kept.append(raw[end:s])
        end = e
    kept.append(raw[end:])
    return b"".join(kept), ranges, len(first), int(gone.sum())


def repeated_runs(docs: DataFrame, doc_id: str, text: str, run: int, min_words: int) -> DataFrame:
    """(id, row, high, low): the runs of each document that an earlier document, in order of (doc_id, row), holds.

    A document gives each of its runs once, so a text that repeats itself adds nothing to a hash. One shuffle brings
    hash and least document together, hash-aggregated on the map side; a second one joins the hashes of more than one
    document back, and AQE splits those that very many hold. Copies of a run are never listed against each other. All
    runs, the largest table here, are deleted before the texts are shuffled.
    """

    def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [list(dict.fromkeys(runs(x, run, min_words)[0])) for x in utf8(batch.column("text"))]
        row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        high, low = halves([h for f in found for h in f])
        return pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), batch.column("id").take(row), batch.column("row").take(row)],
                                          names=["high", "low", "id", "row"])

    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), version(doc_id, text).alias("row"), F.col(text).alias("text"))
    made: list = []
    places = materialize(map_slices(source, spans, f"high long, low long, id {kind}, row long"), "sentence-runs", made)
    # least id and least row of those without an id: a least struct of both would be aggregated by sorting
    first = materialize(places.groupBy("high", "low").agg(
        F.min("id").alias("first_id"), F.min(F.when(F.col("id").isNull(), F.col("row"))).alias("first_row"),
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).drop("n"), "sentence-firsts", made)
    is_first = (F.when(F.col("first_row").isNotNull(), F.col("id").isNull() & (F.col("row") == F.col("first_row")))
                .otherwise(F.col("id") == F.col("first_id")))
    later = materialize(places.join(first, ["high", "low"]).filter(~is_first).select("id", "row", "high", "low"), "sentence-repeats")
    release(docs.sparkSession, made)
    return later


def version(doc_id: str, text: str) -> Column:
    """Tells apart texts without an id; 0 for the others."""
    return F.when(F.col(doc_id).isNull(), row_key(text)).otherwise(F.lit(0).cast("long"))


def dedup_sentences(docs: DataFrame, run: int = 3, min_words: int = 15, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated sentence runs cut from the text, plus ``removed_spans`` (byte ranges of the old text's
    UTF-8), ``n_sentences`` and ``n_removed``; equally named columns of ``docs`` are replaced.

    Null text stays null; a text with fewer than ``run`` sentences or ``min_words`` words has no run and stays. Rows
    that share an id are versions of one document: a run that two of them hold is one occurrence, so equal rows are cut
    alike. Texts without an id sort before all others, equal ones being one document. An empty table gives no rows.
    """
    found = (repeated_runs(docs, doc_id, text, run, min_words)
             .groupBy("id", "row").agg(F.collect_set(F.struct("high", "low")).alias("__runs"))   # at most a text's sentences
             .select(F.col("id").alias("__id"), F.col("row").alias("__row"), "__runs"))
    own = ("removed_spans", "n_sentences", "n_removed", "__runs", "__row", "__id")
    keep = [c for c in docs.columns if c not in own]
    joined = (docs.select(*keep, version(doc_id, text).alias("__version"))
              .join(found, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__version") == F.col("__row")), "left"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(text)
        new, ranges, total, gone = [], [], [], []
        for raw, given, known in zip(utf8(old), batch.column("__runs"), old.is_valid().to_pylist()):
            high, low = (given.values.field(k).to_numpy() for k in (0, 1)) if given.is_valid else halves([])
            t, r, n, g = strip(raw, wholes(high, low), run, min_words)
            new.append(t.decode() if known else None)
            ranges.append([{"start": s, "end": e} for s, e in r])
            total.append(n)
            gone.append(g)
        arrays = [pa.array(new, old.type) if k == text else batch.column(k) for k in keep]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ranges, span), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                          names=[*keep, *own[:3]])

    schema = T.StructType(docs.select(*keep).schema.fields + T._parse_datatype_string(
        "removed_spans array<struct<start:bigint,end:bigint>>, n_sentences bigint, n_removed bigint").fields)
    return map_slices(joined.select(*keep, "__runs"), cut, schema)


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: text without repeated runs, what was cut, and how many sentences."""
    docs = table(spark, sf_dir, "documents")
    return dedup_sentences(docs.select("doc_id", "text")).select("doc_id", "n_sentences", "n_removed", "removed_spans", "text")


def stage_sentence_spans(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: the columns of ``docs``, texts cut, ``n_chars`` (if there) recounted; a text that had
    words and lost all of them goes."""
    cut = dedup_sentences(docs).filter(~((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_sentences"))))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)
