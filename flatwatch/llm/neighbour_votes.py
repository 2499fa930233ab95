"""Quality by votes of the nearest labelled texts in a latent-semantic space.

Terms are hashed byte trigrams, trigrams of byte classes (letter case, digits, marks, ...), and two shares of repeated
words. A bounded sample of labelled rows (``sample`` of them, the least hashes of their ids) gives the term weights,
the latent axes (leading right singular vectors) and the labelled vectors, about a megabyte that every task gets.
Every text is mapped onto the axes, its cosines with all labelled vectors are computed in blocks, and the labels of
the ``k`` nearest are averaged with the cosines as weights.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatwatch.llm.common import fold, map_slices, table, utf8

CHARS, CLASSES, SHARES = 3072, 512, 2
TERMS = CHARS + CLASSES + SHARES
BLOCK = 1 << 20
SAMPLE = 4000

#: Neighbours that vote.
NEIGHBOURS = 15


def byte_classes() -> np.ndarray:
    """0 white space, 1 a-z, 2 A-Z, 3 digits, 4 beyond ASCII, 5 common marks, 7 exclamation marks, 6 other."""
    out = np.full(256, 6, np.uint32)
    for start, end, k in ((97, 122, 1), (65, 90, 2), (48, 57, 3), (128, 255, 4), (9, 13, 0), (32, 32, 0), (33, 33, 7)):
        out[start:end + 1] = k
    out[list(b".,;:?'\"-()")] = 5
    return out


BYTE_CLASS = byte_classes()


def terms(raw: bytes) -> np.ndarray:
    """Counts of the trigrams and, last, the shares of words equal to the one before and of repeated runs of four."""
    out = np.zeros(TERMS, np.float32)
    data = np.frombuffer(raw, np.uint8)
    for start in range(0, max(len(data) - 2, 0), BLOCK):
        b = data[start:start + BLOCK + 2].astype(np.uint32)
        code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        out[:CHARS] += np.bincount((code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(CHARS), minlength=CHARS)
        k = BYTE_CLASS[data[start:start + BLOCK + 2]]
        out[CHARS:CHARS + CLASSES] += np.bincount(k[:-2] << np.uint32(6) | k[1:-1] << np.uint32(3) | k[2:], minlength=CLASSES)
    words = raw.split()
    if len(words) > 1:
        out[-2] = sum(map(eq, words, words[1:])) / len(words)
    if len(words) > 3:
        out[-1] = 1 - len(set(zip(words, words[1:], words[2:], words[3:]))) / (len(words) - 3)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts by inverse document frequency; each kind of trigram is brought to length one, shares to their roots."""
    x = np.log1p(counts[:, :-SHARES]) * idf
    for part in (x[:, :CHARS], x[:, CHARS:]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return np.hstack([x, np.sqrt(np.maximum(counts[:, -SHARES:], 0))]).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def leading_axes(x: np.ndarray, dims: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors of ``x`` as columns, by subspace iteration from a fixed start."""
    dims = min(dims, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(dims + 16, min(x.shape)))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :dims]


@dataclass
class Voters:
    """Labelled vectors and what maps a text to their space."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosines = unit(weighted(counts, self.idf) @ self.axes) @ self.vectors.T
        k = min(self.k, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), self.labels.mean()), 0, 1)


def fit(counts: np.ndarray, labels: np.ndarray, dims: int = 32, k: int = NEIGHBOURS) -> Voters:
    df = (counts[:, :-SHARES] > 0).sum(axis=0)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    if not len(counts):
        return Voters(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), labels, k)
    x = weighted(counts, idf)
    axes = leading_axes(x, dims)
    return Voters(idf, axes, unit(x @ axes), labels.astype(np.float64), k)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, doc_id: str, text: str) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows: those with the least hashes of their ids.

    The ids are chosen from ``labels`` alone (a bounded list, sent to every task), so texts are not shuffled. Null labels
    and ids don't count; of several labels of one id the largest does.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).cast("int").alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample))
    return (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")
            .orderBy(F.xxhash64("__id", "text"), "__id").limit(sample)
            .select("text", F.col("__label").alias("label")))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, dims: int = 32, k: int = NEIGHBOURS,
          doc_id: str = "doc_id", text: str = "text") -> Voters:
    """Voters from a bounded sample of the labelled rows. Without any label every score is one half.

    ``k``: the neighbours that vote, at every size of the sample (all of a smaller one).
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [terms(x) for x in utf8(batch.column("text"))]
        at = [np.flatnonzero(x) for x in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([i.astype(np.int16) for i in at], pa.list_(pa.int16())),
             pa.array([x[i] for x, i in zip(found, at)], pa.list_(pa.float32())), batch.column("label")], names=["at", "n", "label"])

    rows = map_slices(labelled_sample(docs, labels, label, sample, doc_id, text).repartition(8),
                      count, "at array<short>, n array<float>, label int").toArrow()
    counts = np.zeros((rows.num_rows, TERMS), np.float32)
    for x, at, n in zip(counts, rows.column("at"), rows.column("n")):
        x[at.values.to_numpy()] = n.values.to_numpy()
    return fit(counts, rows.column("label").to_numpy(), dims, k)


def score(docs: DataFrame, voters: Voters, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name``: the share of similarity-weighted votes for label 1; a column of that name is replaced.

    Texts are taken whole and nothing is shuffled. A text too short for a trigram, null or empty, has no direction and
    gets the mean label of the sample.
    """
    keep = [c for c in docs.columns if c != name]
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.array([terms(x) for x in utf8(batch.column(text))], np.float32).reshape(-1, TERMS)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sent.value.scores(counts))], names=[*keep, name])

    return map_slices(docs.select(*keep), one, T.StructType([*docs.select(*keep).schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(doc_id: str = "doc_id", parts: int = 5, rest: int = 0):
    return F.coalesce(fold(F.col(doc_id), parts) == rest, F.lit(False))


def op2_neighbour_votes(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """All documents: quality score; labels only of rows whose crc32(doc_id) mod 5 is not 0."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    voters = train(docs, labels.filter(~held_out()), "quality")
    return score(docs, voters).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """The pipeline's stage: the rows of ``docs`` that the classifier keeps, columns as they were."""
    voters = train(docs, table(spark, sf_dir, "labels").filter(~held_out()), "quality")
    return score(docs, voters, name="__score").filter(F.col("__score") >= threshold).drop("__score")
