"""Toxicity by class-conditional Kneser-Ney models.

Texts are byte 5-grams (A-Z lower-cased, runs of other ASCII than letters one space). For each class the probability
of a byte after four is interpolated Kneser-Ney: discounted counts of the class's labelled texts, backed off to
continuation counts -- how many kinds of four bytes go before a byte and the two bytes before it -- that both classes
share and that come from every text of the corpus, labelled or not. What a class hasn't seen therefore costs both
classes alike. Where a four-byte context has evidence, the log ratio of the classes is

    log P(x | h, toxic) - log P(x | h, ordinary),

and for a byte that neither class has seen after it, the ratio of the two back-off weights. Counting, continuation
counts and ratios are Spark aggregates over grams. A ratio is kept under its exact gram or context: up to ``MAX_KEYS`` of
them are sent to tasks as a hash table that grows with their number; more are joined to the distinct grams of chunks of
documents, so that a task holds a chunk's ratios only. The log ratio of a word is the sum over its bytes. A text is
measured by means per word: of its most telling word, three words and six words, and of all words. The largest of many words are larger by chance, so the log
number of words is a term too: what is usual for a length counts as nothing. A logistic curve over these, fitted on a
bounded sample of labelled rows that gave no counts, makes the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import SLICE_ROWS, fold, map_slices, table, utf8
from flatwatch.llm.neighbour_votes import labelled_sample
from flatwatch.session import materialize

#: A-Z lower-cased, other ASCII than letters as space.
LETTERS = np.array([x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256)], np.uint8)
ORDER, SHARED_CONTEXT, DISCOUNT = 5, 2, 0.95
#: Ratios that are broadcast, at about 20 to 28 bytes each; more are joined.
MAX_KEYS = 1 << 22
#: A chunk of documents ends with the row that reaches one of these, where ratios are joined.
CHUNK_ROWS, CHUNK_BYTES = 256, 1 << 22
#: Words whose mean log ratio is measured, the most telling first, and the bounds of a word in the mean of all.
TELLING, BOUNDS = (1, 3, 6), (-3.0, 8.0)
#: Labelled rows that fit the curve, and one in how many labelled rows is kept for it.
CURVE_SAMPLE, CURVE_PART = 4000, 5
#: Distinct grams that a task adds up before it hands them on.
HELD_GRAMS = 1 << 20
BLOCK = 1 << 18
#: Keys of contexts are above those of grams.
CONTEXT = 1 << 8 * ORDER
MIX = 0x9E3779B97F4A7C15


def grams(raw: bytes) -> Iterator[np.ndarray]:
    """The 5-grams of a text as numbers (first byte highest), in blocks; four spaces go before it and one after.

    A text without letters has none.
    """
    data = LETTERS[np.frombuffer(raw, np.uint8)]
    gap = data == 32
    data = data[~gap | np.concatenate(([False], ~gap[:-1]))] if len(data) else data
    if not len(data):
        return
    data = np.concatenate((np.full(ORDER - 1, 32, np.uint8), data, [32])).astype(np.uint64)
    for start in range(0, len(data) - ORDER + 1, BLOCK):
        b = data[start:start + BLOCK + ORDER - 1]
        g = np.zeros(len(b) - ORDER + 1, np.uint64)
        for j in range(ORDER):
            g = g << np.uint64(8) | b[j:len(g) + j]
        yield g


def count_grams(docs: DataFrame, classed: bool) -> DataFrame:
    """(gram, tox, ord): counts by class of ``label`` if ``classed``, else zeros -- there only the kinds matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        room = [0]

        def squeeze(parts: list) -> list:
            if not parts:
                return []
            g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [(g, np.bincount(at, np.concatenate([p[1] for p in parts])))]

        def flush() -> pa.RecordBatch:
            parts = [(k, p) for k in (0, 1) for p in squeeze(held[k])]
            g = np.concatenate([p[0] for _, p in parts]) if parts else np.empty(0, np.uint64)
            n = [np.concatenate([p[1] * (k == c and classed) for k, p in parts]) if parts else np.empty(0) for c in (1, 0)]
            held[0], held[1], room[0] = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), *(pa.array(x.astype(np.int64)) for x in n)],
                                              names=["gram", "tox", "ord"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                labels = part.column("label").to_pylist() if classed else [0] * part.num_rows
                found: list[list] = [[], []]
                for raw, k in zip(utf8(part.column("text")), labels):
                    found[k] += grams(raw)
                for k in (0, 1):
                    if found[k]:
                        g, n = np.unique(np.concatenate(found[k]), return_counts=True)
                        held[k].append((g, n))
                        room[0] += len(g)
                if room[0] > HELD_GRAMS:
                    held[0], held[1] = squeeze(held[0]), squeeze(held[1])
                    room[0] = sum(len(p[0]) for k in held for p in k)
                    if room[0] > HELD_GRAMS // 2:
                        yield flush()
        yield flush()

    return docs.mapInArrow(run, "gram long, tox long, ord long")


def ratios(counts: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """(key, ratio) of every gram and, ``CONTEXT`` added to it, every context with evidence, from (gram, tox, ord).

    Grams without evidence count for the shared continuation counts.
    """
    low = F.col("gram").bitwiseAND(F.lit((1 << 8 * (SHARED_CONTEXT + 1)) - 1).cast("long"))
    kinds = counts.groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("n"))
    above = kinds.groupBy(F.shiftright("low", 8).alias("ctx")).agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("types"))
    shared = (kinds.join(above, F.shiftright("low", 8) == F.col("ctx"))
              .select("low", ((F.greatest(F.col("n") - F.lit(discount), F.lit(0.0)) + discount * F.col("types") / 256)
                              / F.col("all")).alias("p")))
    seen = counts.filter((F.col("tox") > 0) | (F.col("ord") > 0)).withColumn("low", low).withColumn("h", F.shiftright("gram", 8))
    kind = lambda c: F.sum((F.col(c) > 0).cast("long"))
    contexts = seen.groupBy("h").agg(F.sum("tox").alias("all_t"), F.sum("ord").alias("all_o"), kind("tox").alias("types_t"),
                                     kind("ord").alias("types_o"))
    back = lambda c: F.when(F.col(f"all_{c}") > 0, discount * F.col(f"types_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    def p(n: str, c: str) -> Column:
        own = F.when(F.col(f"all_{c}") > 0, F.greatest(F.col(n) - F.lit(discount), F.lit(0.0)) / F.col(f"all_{c}")).otherwise(0.0)
        return own + back(c) * F.col("p")

    explicit = (seen.join(shared, "low").join(contexts, "h")
                .select(F.col("gram").alias("key"), (F.log(p("tox", "t")) - F.log(p("ord", "o"))).cast("float").alias("ratio")))
    unseen = contexts.select((F.col("h") + F.lit(CONTEXT)).alias("key"), (F.log(back("t")) - F.log(back("o"))).cast("float").alias("ratio"))
    return explicit.unionByName(unseen)


class Ratios:
    """Ratios by exact key: the keys in order of their slots, and where each slot starts; two to four slots for a key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, len(keys).bit_length() + 1)
        slots = self.slot(keys)
        order = np.argsort(slots, kind="stable")
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(slots, minlength=1 << self.bits)))).astype(np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        x = (keys + np.uint64(1)) * np.uint64(MIX)
        return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ratios of ``keys``, NaN for those that have none."""
        slots = self.slot(keys)
        at, end = self.first[slots], self.first[slots + 1]
        out = np.full(len(keys), np.nan)
        left = np.flatnonzero(at < end)
        while len(left):
            place = at[left]
            same = self.keys[place] == keys[left]
            out[left[same]] = self.values[place[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def ratio_table(found: DataFrame) -> Ratios | DataFrame:
    """All of ``found``, to be broadcast; beyond ``MAX_KEYS`` rows as a written table, to be joined."""
    found = materialize(found, "kn-ratios")
    if found.count() > MAX_KEYS:
        return found
    rows = found.toArrow()                                                                          # at most MAX_KEYS rows
    return Ratios(rows.column("key").to_numpy().view(np.uint64), rows.column("ratio").to_numpy())


def in_chunks(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``__chunk``: neighbouring rows, in bounded number and bytes. Write it before use: chunks depend on the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows, size = TaskContext.get().partitionId() << 40, 0, 0
        for batch in batches:
            out = []
            for n in pa.compute.binary_length(batch.column(text)).to_pylist():
                if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
                    chunk, rows, size = chunk + 1, 0, 0
                rows, size = rows + 1, size + (n or 0)
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "__chunk"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__chunk", T.LongType())]))


def keys_asked(chunks: DataFrame, text: str) -> DataFrame:
    """(__chunk, key): the grams and contexts of every chunk, once for each slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found: dict[int, list] = {}
                for raw, c in zip(utf8(part.column(text)), part.column("__chunk").to_pylist()):
                    found.setdefault(c, []).extend(np.unique(g) for g in grams(raw))
                for c, parts in found.items():
                    if parts:
                        g = np.unique(np.concatenate(parts))
                        keys = np.concatenate((g, np.unique(g >> np.uint64(8)) + np.uint64(CONTEXT))).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), c)), pa.array(keys)], names=["__chunk", "key"])

    return chunks.select("__chunk", text).mapInArrow(run, "__chunk long, key long")


def with_ratios(docs: DataFrame, ratio: Ratios | DataFrame, fn: Callable[[pa.RecordBatch, Ratios], pa.RecordBatch],
                schema: str | T.StructType, text: str = "text") -> DataFrame:
    """``fn`` over slices of ``docs`` and the ratios of all grams of their texts. Nothing is shuffled if ``ratio`` is in memory."""
    if isinstance(ratio, Ratios):
        sent = docs.sparkSession.sparkContext.broadcast(ratio)
        return map_slices(docs, lambda batch: fn(batch, sent.value), schema)

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        own = Ratios(known.column("key").to_numpy().view(np.uint64), known.column("ratio").to_numpy())
        return pa.Table.from_batches([fn(b.slice(at, SLICE_ROWS), own) for b in rows.to_batches() for at in range(0, b.num_rows, SLICE_ROWS)])

    chunks = materialize(in_chunks(docs, text), "kn-chunks")
    known = keys_asked(chunks, text).join(ratio.hint("merge"), "key").select("__chunk", "key", "ratio")
    return chunks.groupBy("__chunk").cogroup(known.groupBy("__chunk")).applyInArrow(run, schema)


def word_ratios(raw: bytes, ratio: Ratios) -> np.ndarray:
    """The log ratio of each word, in order."""
    sums, ends = [], []
    for g in grams(raw):
        r = ratio.find(g)
        none = np.flatnonzero(np.isnan(r))
        r[none] = np.nan_to_num(ratio.find((g[none] >> np.uint64(8)) + np.uint64(CONTEXT)))
        sums.append(r)
        ends.append((g & np.uint64(255)) == 32)
    if not sums:
        return np.empty(0)
    end = np.flatnonzero(np.concatenate(ends))
    return np.diff(np.concatenate(([0.0], np.cumsum(np.concatenate(sums))))[np.concatenate(([0], end + 1))])


def means(words: np.ndarray) -> np.ndarray:
    """Mean log ratios of the most telling words (missing ones count as 0) and, in bounds, of all. No words: zeros."""
    out = np.zeros(len(TELLING) + 1)
    if len(words):
        most = max(TELLING)
        top = np.zeros(most)
        best = np.partition(words, len(words) - most)[-most:] if len(words) > most else words
        top[:len(best)] = np.sort(best)[::-1]
        out[:-1] = [top[:k].mean() for k in TELLING]
        out[-1] = np.clip(words, *BOUNDS).mean()
    return out


def measures(raw: bytes, ratio: Ratios) -> np.ndarray:
    """The :func:`means` of a text."""
    return means(word_ratios(raw, ratio))


def terms(raw: bytes, ratio: Ratios) -> np.ndarray:
    """What the curve is over: the means, scaled, and the log number of words (of 150 words: 0; no words count as one)."""
    words = word_ratios(raw, ratio)
    return np.append(means(words) * SCALE, np.log(max(len(words), 1) / 150))


#: Brings the measures to one scale for the curve.
SCALE = np.array([0.4] * len(TELLING) + [4.0])


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60, scale: np.ndarray | float = SCALE) -> np.ndarray:
    """Intercept and slopes of a ridge logistic regression. Without both classes: the smoothed share, whatever ``x``."""
    w = np.zeros(x.shape[1] + 1)
    if len(np.unique(y)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        w[0] = np.log(share / (1 - share))
        return w
    a = np.c_[np.ones(len(x)), x * scale]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def on_curve(x: np.ndarray, curve: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30))))


@dataclass
class Model:
    ratio: Ratios | DataFrame
    curve: np.ndarray


def for_curve() -> Column:
    return F.pmod(F.xxhash64(F.lit("curve"), F.col("doc_id")), F.lit(CURVE_PART)) == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          curve_sample: int = CURVE_SAMPLE) -> Model:
    """The model of all ``docs`` and of the labels given; null labels and ids don't count, of several for an id the largest does."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label")))
    # a shuffle join at every size: labels grow with the corpus, and a broadcast that only small inputs get would hide its cost
    classed = plain.join(known.filter(~for_curve()).hint("merge"), "doc_id").select("text", "label")
    counts = (count_grams(classed, True).unionByName(count_grams(plain.select("text"), False))
              .groupBy("gram").agg(F.sum("tox").alias("tox"), F.sum("ord").alias("ord")))
    ratio = ratio_table(ratios(materialize(counts, "kn-counts")))

    def one(batch: pa.RecordBatch, known: Ratios) -> pa.RecordBatch:
        x = [terms(t, known) for t in utf8(batch.column("text"))]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])

    sample = labelled_sample(plain, known.filter(for_curve()).withColumnRenamed("label", "toxic"), "toxic", curve_sample, "doc_id", "text")
    rows = with_ratios(sample.repartition(8), ratio, one, "x array<double>, label int").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(SCALE) + 1)
    return Model(ratio, fit_curve(x, rows.column("label").to_numpy(), scale=1.0))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name``: probability of label 1; a column of that name is replaced.

    Whole texts are scored; nothing is shuffled unless the model's ratios are joined. Null texts and such without letters measure 0.
    """
    keep = [c for c in docs.columns if c != name]
    curve = model.curve

    def one(batch: pa.RecordBatch, known: Ratios) -> pa.RecordBatch:
        s = [on_curve(terms(x, known), curve) for x in utf8(batch.column(text))]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(s, pa.float64())], names=[*keep, name])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(name, T.DoubleType())])
    return with_ratios(docs.select(*keep), model.ratio, one, schema, text)


def op7_kneser_ney_tox(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """All documents: toxicity score; labels only of rows whose crc32(doc_id) mod 4 is not 2."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs, labels.filter(~out), "toxic")
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
