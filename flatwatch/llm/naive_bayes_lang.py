"""Language identification: multinomial naive Bayes over hashed character n-grams (1 to 4) of letters.

Texts are lower-cased by Unicode's rules; code points that are neither letters nor marks become spaces. Counts cover
every training row: tasks add them up by language, Spark sums them by (language, bin). The matrix of log-probabilities,
``2 ** bits`` bins x languages in floats, goes to every task. A slice of texts becomes a sparse matrix of counts, a row
for each text and an entry for each bin that it holds, and is multiplied with the log matrix in numpy.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import SLICE_ROWS, map_slices, table, texts
from flatwatch.llm.neighbour_votes import held_out
from flatwatch.session import materialize

ORDERS = (1, 2, 3, 4)
#: Characters whose n-grams are held at once; longer texts come in parts.
BLOCK = 1 << 18
#: Languages whose counts a task holds at once, before it hands them on.
HELD = 32
#: Languages of a model: with 16 bits the matrix has a quarter of a MB for each. More are an error.
MAX_LANGS = 1000
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter or a mark."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


def parts(rows: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, row of each, whether an n-gram starts there) of texts, a space before and after each, in blocks.

    The parts of a long text overlap by the length of the longest n-gram less one; n-grams start in one of them only.
    A part of full length ends its block, so no two parts of one text are side by side.
    """
    held, size = [], 0
    more = max(ORDERS) - 1
    for i, text in enumerate(rows):
        points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        data = np.full(len(points) + 2, 32, np.uint32)
        data[1:-1] = np.where(letters()[points], points, np.uint32(32))
        for start in range(0, len(data), BLOCK):
            own = data[start:start + BLOCK + more]
            held.append((own, np.full(len(own), i), np.arange(len(own)) < BLOCK))
            size += len(own)
            if size >= BLOCK:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def bins(rows: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bin) of all n-grams of texts, in blocks."""
    for points, row, begins in parts(rows):
        found = []
        for n in ORDERS:
            size = len(points) - n + 1
            if size <= 0:
                continue
            at = np.flatnonzero(begins[:size] & (row[:size] == row[n - 1:]))
            g = np.full(len(at), n, np.uint32)
            for j in range(n):
                g = (g ^ points[at + j]) * np.uint32(0x01000193)
                g ^= g >> np.uint32(15)
            found.append((row[at], g * np.uint32(2654435761) >> np.uint32(32 - bits)))
        yield tuple(np.concatenate(x) for x in zip(*found))


def sparse_counts(rows: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bin, count) of the entries of the texts' count matrix, by row and bin; a long text's come in several blocks."""
    for row, at in bins(rows, bits):
        key = np.sort(row.astype(np.uint64) << np.uint64(bits) | at)
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, n = key[first], np.diff(np.append(first, len(key)))
        yield (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64), n


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    logs: np.ndarray            # bins x languages
    bits: int

    def posteriors(self, rows: list[str]) -> np.ndarray:
        """Texts x languages."""
        out = np.tile(self.prior, (len(rows), 1))
        for row, at, n in sparse_counts(rows, self.bits):
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            out[row[first]] += np.add.reduceat(self.logs[at] * n[:, None].astype(np.float64), first, axis=0)
        out -= out.max(axis=1, keepdims=True)
        p = np.exp(out)
        return p / p.sum(axis=1, keepdims=True)


def train(docs: DataFrame, bits: int = 16, alpha: float = 0.5, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows with a language; null texts count for the prior alone. Ties of languages go by name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            at = {k: np.flatnonzero(v) for k, v in held.items()}
            out = pa.RecordBatch.from_arrays(
                [pa.array([k for k, i in at.items() for _ in range(len(i))], pa.string()),
                 pa.array(np.concatenate([i - 1 for i in at.values()])), pa.array(np.concatenate([held[k][i] for k, i in at.items()]))],
                names=["lang", "bin", "n"])
            held.clear()
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                by_lang: dict[str, list[str]] = {}
                for t, k in zip(texts(part.column("text")), part.column("lang").to_pylist()):
                    by_lang.setdefault(k, []).append(t)
                for k, own in by_lang.items():
                    if k not in held and len(held) == HELD:
                        yield flush()
                    n = held.setdefault(k, np.zeros((1 << bits) + 1, np.int64))
                    n[0] += len(own)                                       # texts, as bin -1
                    for _, at in bins(own, bits):
                        n[1:] += np.bincount(at, minlength=1 << bits)
        if held:
            yield flush()

    source = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(F.col("lang").isNotNull())
    counted = materialize(source.mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")),
                          "lang-counts")
    many = counted.select("lang").distinct().count()
    if many > MAX_LANGS:
        raise ValueError(f"{many} languages to learn, more than {MAX_LANGS}: the matrix would not fit")
    rows = counted.toArrow()                                                # at most MAX_LANGS x (bins + 1) rows
    langs = sorted(set(rows.column("lang").to_pylist()))
    place = {k: i for i, k in enumerate(langs)}
    index = np.array([place[k] for k in rows.column("lang").to_pylist()], np.int64)
    counts = np.zeros((len(langs), (1 << bits) + 1))
    np.add.at(counts, (index, rows.column("bin").to_numpy() + 1), rows.column("n").to_numpy())
    n_texts, counts = counts[:, 0], counts[:, 1:]
    logs = np.log((counts + alpha) / (counts.sum(axis=1, keepdims=True) + alpha * (1 << bits)))
    prior = np.log(np.maximum(n_texts, 1) / max(n_texts.sum(), 1))
    return Model(langs, prior, np.ascontiguousarray(logs.T.astype(np.float32)), bits)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (its posterior); columns of those names are replaced.

    A null text, one without a letter, and every text if no language was learned, are ``und`` with score 0. Texts are
    read whole; nothing is shuffled.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        rows = batch.column(text).to_pylist()
        known = [i for i, t in enumerate(rows) if t is not None and m.langs and has_letter(t)]
        langs, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
        if known:
            p = m.posteriors([rows[i] for i in known])
            for i, row in zip(known, p):
                best = int(np.argmax(row))
                langs[i], score[i] = m.langs[best], row[best]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(langs, pa.string()), pa.array(score)],
                                          names=[*keep, "lang_pred", "score"])

    fields = [*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_slices(docs.select(*keep), one, T.StructType(fields))


def op9_naive_bayes_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; learned from text and lang of those whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()).select("text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
