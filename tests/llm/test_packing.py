import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flatwatch.llm import best_fit_reduction as bf
from flatwatch.llm import packed_ids as pi
from flatwatch.llm.token_pieces import encoder, piece_bounds

TEXTS = ["", " ", "Plain words, and <|endoftext|> inside.", "a  b\n\n c\t", "né à l'été — 東京 🙂", "x" * 5000, "don't we'll I'm 123 45",
         "word " * 3000, None]


def reference_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_equal_the_tokenizers_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    encode, t = encoder(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for text in [r.text for r in docs] + [x for x in TEXTS if x is not None]:
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def least_bins(sizes, capacity):
    """Exact number of bins, by dynamic programming over subsets."""
    n = len(sizes)
    best = [(n + 1, 0)] * (1 << n)
    best[0] = (0, capacity)
    for mask in range(1, 1 << n):
        options = []
        for i in range(n):
            if mask >> i & 1:
                bins, used = best[mask ^ 1 << i]
                options.append((bins, used + sizes[i]) if used + sizes[i] <= capacity else (bins + 1, sizes[i]))
        best[mask] = min(options)
    return best[-1][0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 37])
    low = rng.choice([1, capacity // 4, capacity // 3])
    sizes = [rng.randint(max(1, low), capacity) for _ in range(rng.randint(1, 11))]
    counts = {s: sizes.count(s) for s in sizes}
    fixed, left = bf.reduce_classes(counts, capacity)
    rest = [s for s, c in left.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + least_bins(rest, capacity) == least_bins(sizes, capacity)
    patterns = bf.plan(counts, capacity)
    packed = sorted(s for p, t in patterns for _ in range(t) for s, k in p for _ in range(k))
    assert packed == sorted(sizes) and all(sum(s * k for s, k in p) <= capacity for p, _ in patterns)


def test_class_best_fit_is_best_fit():
    for seed in range(40):
        rng = random.Random(seed)
        capacity = 50
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(1, 200))), reverse=True)
        rooms = []
        for s in sizes:
            fit = [r for r in rooms if r >= s]
            rooms.remove(min(fit)) if fit else None
            rooms.append((min(fit) if fit else capacity) - s)
        patterns = bf.best_fit({s: sizes.count(s) for s in sizes}, capacity)
        assert sum(t for _, t in patterns) == len(rooms)
        sequence, offset = pi.best_fit_decreasing(np.array(sizes), capacity)
        assert sequence.max() + 1 == len(rooms)


def check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack_documents(spark, capacity):
    rows = [(i, t, 0, "x") for i, t in enumerate(TEXTS * 3)] + [(None, "no id", 1, "y"), (2, TEXTS[2], 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string")
    got = bf.pack_documents(df, capacity).collect()
    n = check_layout(got, capacity)
    tokens = sum(len(reference_ids(r[1])) for r in rows)
    assert sum(r.length for r in got) == tokens and -(-tokens // capacity) <= n <= -(-tokens // capacity) + 3
    want = []
    for i, t, *_ in rows:
        ids = np.array(reference_ids(t), "<u4")
        want += [(str(i), p, s, k, zlib.crc32(ids[s:s + k].tobytes())) for p, (s, k) in enumerate(piece_bounds(len(ids), capacity))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert bf.pack_documents(df.limit(0), capacity).count() == 0


def test_pieces_and_bad_sizes():
    assert piece_bounds(5, 5) == [(0, 5)] and piece_bounds(6, 5) == [(0, 1), (1, 5)] and piece_bounds(1, 5) == [(0, 1)]
    with pytest.raises(ValueError):
        bf.plan({11: 1}, 10)
    assert bf.plan({}, 10) == []


def test_room_tree():
    for a, b in combinations(range(11), 2):
        tree = pi.RoomTree(10)
        tree.add(a, 1)
        tree.add(b, 1)
        for room in range(11):
            assert tree.least(room) == min((x for x in (a, b) if x >= room), default=None)


@pytest.mark.parametrize("capacity,group_bytes,vocabulary", [(16, 8_000_000, 50_257), (64, 500, 100_000), (2048, 2000, 50_257)])
def test_packed_round_trip(spark, tmp_path, capacity, group_bytes, vocabulary):
    rows = [(i, t, 0, "x") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string")
    path = str(tmp_path / "packed")
    pi.write_packed(df, path, capacity=capacity, group_bytes=group_bytes, vocabulary=vocabulary, pad_id=7)
    out, dtype = {}, "<u2" if vocabulary < 1 << 16 else "<u4"
    got = spark.read.parquet(path).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    for r in got:
        ids, cu = np.frombuffer(r.ids, dtype), r.cu_seqlens
        assert len(ids) == capacity and cu[0] == 0 and cu[-1] == r.n_tokens and (ids[cu[-1]:] == 7).all()
        positions = np.frombuffer(r.positions, "<u2")
        want = np.concatenate([np.arange(b - a) for a, b in zip([*cu], [*cu[1:], capacity])])
        assert (positions == want).all()
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, cu, cu[1:]):
            assert (doc, piece) not in out
            out[doc, piece] = ids[a:b].tolist()
    for i, t, *_ in rows:
        pieces = [out.pop((i, p)) for p in range(sum(k[0] == i for k in out))]
        assert sum(pieces, []) == reference_ids(t)
    assert not out
    assert pi.packed(df.limit(0)).count() == 0


def test_registered_packings(spark):
    """op1 and op6 over a whole table: every id is in one place, sequences are gapless and within their size."""
    sf = "/root/testdata/sf0.001"
    ids = {r.doc_id: reference_ids(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    by_doc, by_sequence = {}, {}
    for r in bf.op1_best_fit_reduction(spark, sf).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length])
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(ids[i]) and all(r.length == 1024 for r in pieces[1:])
        assert len(pieces) == -(-len(ids[i]) // 1024)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) <= 1024
    assert len(by_sequence) <= -(-sum(map(len, ids.values())) // 1024) * 1.05 + 1
    rows = pi.op6_packed_ids(spark, sf).collect()
    assert {i for r in rows for i in r.doc_ids} == set(ids) and sum(r.n_tokens for r in rows) == sum(r.cu_seqlens[-1] for r in rows)
    assert all(r.cu_seqlens[0] == 0 and list(r.cu_seqlens) == sorted(r.cu_seqlens) and r.n_tokens <= 2048 for r in rows)
    assert len({r.sequence_id for r in rows}) == len(rows)
