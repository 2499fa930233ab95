import random

import pytest

from flatwatch.llm import qgram_decontam as qd


def distance(item, text):
    """Least edits between the item and any substring."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def noisy(rng, s, edits):
    s = list(s)
    for _ in range(edits):
        i = rng.randrange(len(s))
        kind = rng.random()
        if kind < 0.4:
            s[i] = rng.choice("abcdé ")
        elif kind < 0.7:
            s.insert(i, rng.choice("abcdé"))
        elif len(s) > 1:
            del s[i]
    return "".join(s)


def fixture(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "on", "é", "re", "an"]) for _ in range(rng.randint(1, 4)))
    words = lambda n: " ".join(word() for _ in range(n))
    items = [(i, words(rng.randint(2, 20))) for i in range(12)] + [(50, None), (51, ""), (52, "ab"), (0, words(9))]
    docs = []
    for i in range(60):
        t = words(rng.randint(1, 40))
        if rng.random() < 0.8:
            item = rng.choice(items[:12])[1]
            t += " " + noisy(rng, item.upper() if i % 3 else item, rng.randint(0, len(item) // 7)) + "\n " + words(rng.randint(0, 20))
        docs.append((i, t))
    return docs + [(60, None), (61, ""), (None, items[3][1]), (5, docs[5][1])], items


def test_every_place_within_the_budget_and_none_beyond(spark):
    docs, items = fixture()
    got = qd.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for i, t in docs:
        for j, s in items:
            s = qd.normalize(s or "")
            if s:
                d = distance(s, qd.normalize(t or ""))
                if d <= len(s) // 10:
                    want.setdefault((i, j), []).append(d)
    assert {(r.doc_id, r.item_id) for r in got} == set(want) and len(want) > 30
    best = {}
    for r in got:
        best[r.doc_id, r.item_id] = min(best.get((r.doc_id, r.item_id), 99), r.edits)
    assert best == {k: min(v) for k, v in want.items()}
    text = dict(docs)
    for r in got:
        part = qd.normalize(text[r.doc_id][r.start:r.end])
        assert min(distance(part, qd.normalize(s)) for j, s in items if j == r.item_id and s) <= r.edits


def test_blocks_and_filter(spark):
    docs, items = fixture(9)
    d = spark.createDataFrame([(i, t, "z", 1) for i, t in docs], "doc_id long, text string, item_id string, edits int")
    b = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc_id string")
    whole = {tuple(r) for r in qd.contaminated(d, b).collect()}
    assert {tuple(r) for r in qd.contaminated(d, b, block_chars=200).collect()} == whole
    for block in (200, 10**6):
        kept = qd.decontaminate(d, b, block_chars=block)
        assert kept.columns == d.columns
        bad = {r[0] for r in whole}
        assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "an item of text")], "item_id long, text string")
    assert qd.contaminated(d.limit(0), b).count() == 0
    assert qd.contaminated(d, b.limit(0)).count() == 0
    assert qd.decontaminate(d, b.limit(0)).count() == 1


@pytest.mark.parametrize("q", [1, 2, 3, 5, 8, 13])
def test_gram_hashes(q):
    x = qd.codes("abcabcabcabc xyz abcabcabc")
    h = qd.gram_hashes(x, q).tolist()
    grams = [tuple(x[i:i + q]) for i in range(len(x) - q + 1)]
    assert len(h) == len(grams) and all((a == b) == (g == k) for a, g in zip(h, grams) for b, k in zip(h, grams))


def test_repetitive_and_long_text():
    item = "spam eggs " * 20
    index = qd.Index([(1, item)], 8, 0.1)
    text = "x" * 100_000 + " " + "spam eggs " * 200 + "y" * 100_000
    hits = index.search(text)
    assert hits and all(h[3] == 0 for h in hits)
    assert index.search("spam egg " * 3) == []


def test_items_of_every_length(spark):
    """One to forty characters, by the rate of 10 % alone; the registered query on the given tables."""
    rng = random.Random(11)
    items = [(m * 10 + n, "".join(rng.choice("abcdefgh") for _ in range(m))) for m in range(1, 41) for n in range(2)]
    items += [(900, "what is 6x7? 42"), (901, "12345678901234567890123456789ab")]
    docs = []
    for i in range(150):
        _, item = rng.choice(items)
        docs.append((i, "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 30))) + noisy(rng, item, rng.randint(0, len(item) // 10 + 1))))
    docs += [(500, "zz what is 6y7? 42 zz"), (501, "zz 1234567890x234567890y23456789zab")]
    got = qd.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(i, j) for i, t in docs for j, s in items if distance(s, qd.normalize(t)) <= len(s) // 10}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert {(500, 900), (501, 901)} <= want


def test_registered(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet").select(k, "text").collect() for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {(r.doc_id, r.item_id) for r in qd.op8_qgram_decontam(spark, sf).collect()}
    plain = {(d.doc_id, i.item_id) for d in docs for i in items if qd.normalize(i.text or "") and qd.normalize(i.text) in qd.normalize(d.text or "")}
    assert plain <= got and plain
    near = {i.item_id: qd.normalize(i.text) for i in items if i.text}
    text = {d.doc_id: qd.normalize(d.text or "") for d in docs}
    assert all(distance(near[j], text[i]) <= len(near[j]) // 10 for i, j in list(got - plain)[:20])
