import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flatwatch.llm import cutting_stock as cs
from flatwatch.llm.cutting_stock import op12_cutting_stock

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, sequence_id int"


def patterns_of(sizes, room):
    """All multisets of sizes that fit."""
    for times in itertools.product(*[range(room // s + 1) for s in sizes]):
        if sum(t * s for t, s in zip(times, sizes)) <= room:
            yield times


@pytest.mark.parametrize("seed", range(8))
def test_program_is_solved(seed):
    """Weak duality: a plan that covers the needs and prices that no pattern beats, of equal value, are both optimal."""
    rng = random.Random(seed)
    room = rng.choice([10, 17, 24])
    sizes = np.array(sorted(rng.sample(range(2, room + 1), 5)))
    need = np.array([rng.randint(50, 5000) for _ in sizes])
    patterns, x, duals = cs.solve(sizes, need, room, gap=0.0)
    assert (patterns @ sizes <= room).all() and (x >= 0).all() and (duals >= 0).all()
    assert (x @ patterns >= need - 1e-3).all()
    assert max(np.dot(p, duals) for p in patterns_of(sizes, room)) <= 1 + 1e-9
    assert x.sum() <= duals @ need + 0.51                     # stops within half a sequence
    prices = np.array([rng.random() for _ in sizes])
    assert abs(cs.best_pattern(sizes, prices, room)[0] - max(np.dot(p, prices) for p in patterns_of(sizes, room))) < 1e-9


def check(rows, sizes, capacity):
    """rows: (key, start, length, sequence, offset); sizes: length of each key. No id twice, no gap, no padding."""
    docs, bins = defaultdict(list), defaultdict(list)
    for key, start, length, sequence, offset in rows:
        assert length > 0
        docs[key].append((start, length))
        bins[sequence].append((offset, length))
    assert set(docs) == set(sizes)
    for group, whole in [(v, sizes[k]) for k, v in docs.items()] + [(v, None) for v in bins.values()]:
        at = 0
        for start, length in sorted(group):
            assert start == at
            at += length
        assert at == whole if whole is not None else at == capacity or at & (at - 1) == 0
        assert whole is not None or at <= capacity
    total = sum(sizes.values())
    assert len(bins) == total // capacity + (total % capacity).bit_count()


@pytest.mark.parametrize("seed", range(30))
def test_plan_covers_everything(seed):
    rng = random.Random(seed)
    capacity, grid = rng.choice([(16, 1), (64, 4), (64, 8), (100, 8), (256, 16), (32, 32)])
    kind = rng.choice(["any", "few", "large", "same"])
    top = {"any": capacity, "few": 3, "large": capacity, "same": 1}[kind]
    lengths = [max(1, capacity * 2 // 3 + rng.randint(0, capacity // 4) if kind == "large" else rng.randint(1, top))
               for _ in range(rng.choice([1, 2, 30, 400]))]
    if kind == "same":
        lengths = [capacity // 2 + 1] * len(lengths)
    counts = Counter(lengths)
    places = cs.Places(cs.plan(dict(counts), capacity, grid))
    keys = [(n, r) for n, c in counts.items() for r in range(c)]
    row, *parts = places.parts(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]))
    check([(keys[i], *map(int, p)) for i, *p in zip(row, *parts)], {k: k[0] for k in keys}, capacity)


def test_plan_of_nothing_and_bad_lengths():
    assert cs.plan({}) == [] and cs.plan({5: 0}) == []
    for bad in ({0: 1}, {2049: 1}):
        with pytest.raises(ValueError):
            cs.plan(bad)


def test_few_documents_are_cut():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(5, 1, 20_000).astype(int), 1, 2048)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    runs = cs.plan(counts)
    cut = sum(r.count for r in runs if r.places[0][1] < r.length)
    assert cut < 0.03 * len(lengths)


def rows_of(df):
    return [(r["doc_id"], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in df.collect()]


def test_documents(spark):
    """Nulls, empty and long texts, repeated rows, a clashing column; ids are those of the tokenizers library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    given = [(1, None, 0), (2, "", 0), (3, "a b " * 700, 0), (4, "x y z", 0), (5, "<|endoftext|> żółw", 0)] + [(6 + i, "ab c " * i, 0) for i in range(40)]
    df = cs.pack_cutting_stock(spark.createDataFrame(given, SCHEMA), capacity=64, grid=4)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t, _ in given}
    check(rows_of(df), {d: len(x) for d, x in ids.items()}, 64)
    for r in df.collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4")) and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u2").tolist() == part
    twice = cs.pack_cutting_stock(spark.createDataFrame([(None, "a b c", 0), (None, "a b c", 0), (7, "a b c", 0), (7, "a b c", 0)], SCHEMA), capacity=4, grid=1)
    assert twice.agg(F.sum("length")).first()[0] == 16
    assert cs.pack_cutting_stock(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered(spark):
    got = op12_cutting_stock(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    sizes = {r["doc_id"]: r["doc_tokens"] for r in got.select("doc_id", "doc_tokens").distinct().collect()}
    assert len(sizes) == spark.read.parquet(f"{SF}/documents.parquet").count()
    check(rows_of(got), sizes, 2048)
