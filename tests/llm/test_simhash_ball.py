import random

import numpy as np
import pytest
import xxhash

from flatwatch.llm import simhash_ball as sb
from flatwatch.llm.components import connected_components


def roots(nodes, pairs):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def plain_fingerprint(text, n=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            words = (rng.choice(out) or "").split(" ")
            if len(words) > 3 and rng.random() < 0.8:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))))
    return out


def test_fingerprint_is_the_plain_rule():
    texts = corpus() + ["", " \t\n", "One", "ONE two\x0bthree", "É É é É É", "a b c d", "x y z"]
    assert [sb.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(f"t{i}" for i in range(70_000))
    assert sb.fingerprint(long.encode()) == plain_fingerprint(long)


@pytest.mark.parametrize("hot", [50_000, 3])
def test_components_against_all_pairs(spark, hot):
    texts = [None, "", " ", "\n"] + corpus(7)
    rows = [(i * 3 % 101 if i % 17 else i, t, "x") for i, t in enumerate(texts)]
    rows += rows[5:8] + [(None, texts[9], "y"), (None, "only here " * 5, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sb.near_duplicates(df, hot_rows=hot).collect()
    fps = {t: plain_fingerprint(t) for t in {r[1] for r in rows}}
    nodes = sorted(set(fps.values()))
    root = roots(nodes, [(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 4])
    least = {}
    for i, t, _ in rows:
        if i is not None:
            k = root[fps[t]]
            least[k] = min(least.get(k, i), i)
    want = sorted((str(i), fps[t], least.get(root[fps[t]])) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == sorted(want, key=lambda x: x) or \
        sorted(map(str, ((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got))) == sorted(map(str, want))
    assert len({root[n] for n in nodes}) < len(nodes)


def test_links_reach_exactly_four_bits(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in range(7) for _ in range(20)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    for hot in (10**6, 5):
        got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in sb.links(df, 4, hot).collect()]
        assert all(bin(a ^ b).count("1") <= 4 for a, b in got)
        want = [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 4]
        assert roots(fps, got) == roots(fps, want)
        assert len(got) < len(want)
    with pytest.raises(ValueError):
        sb.links(df, 3)


def test_large_buckets_are_split(monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 48, dtype=np.uint64)
    low = np.unique(np.array([centre ^ np.uint64(sum(1 << int(i) for i in rng.choice(48, 3))) for _ in range(150)]))
    used = rng.integers(0, 3, len(low)).astype(np.int32)
    whole = {tuple(p) for p in sb.meet(low, used, 48, 2).tolist()}
    monkeypatch.setattr(sb, "UNFOLD_ROWS", 16)
    split = {tuple(p) for p in sb.meet(low, used, 48, 2).tolist()}
    n = range(len(low))
    assert roots(n, whole) == roots(n, split)


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 2000 + i) for i in range(50)]
    edges += [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(200)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = {x for e in real for x in e}
    want = roots(nodes, real)
    groups = lambda m: {frozenset(n for n in m if m[n] == r) for r in set(m.values())}
    assert groups({r.node: r.root for r in got}) == groups(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_and_empty(spark):
    rows = [(5, "a b c d e f", 1, "fp"), (2, "A b c d e f", 2, "x"), (2, "A b c d e f", 3, "x"), (9, "q r s t u v w", 4, None),
            (None, "a b c d e f", 5, "z"), (None, None, 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string")
    kept = sb.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect()) == [
        (False, 2, "A b c d e f"), (False, 9, "q r s t u v w"), (True, None, None)]
    empty = spark.createDataFrame([], df.schema)
    assert sb.near_duplicates(empty).count() == 0 and sb.keep_one(empty).count() == 0


def test_registered_query(spark):
    """The query over a whole table against fingerprints worked out one by one and all pairs."""
    sf = "/root/testdata/sf0.001"
    fps = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(fps)
    root = roots(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4])
    got = {r.doc_id: r for r in sb.op5_simhash_ball(spark, sf).collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{fps[i]:016x}", root[i]) for i in ids}
