import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from flatwatch.llm import fragment_alignment as fa
from flatwatch.llm.fragment_alignment import op11_fragment_alignment

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, rid int, chunk string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_decoder():
    """The usual printable stand-ins of bytes in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + n)
    return {c: b for b, c in chars.items()}


def brute(docs):
    """Straight from the definition, with the tokenizers and sentencepiece libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    ta = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    decode = byte_decoder()
    piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()
    groups = []
    for _, text in docs:
        if not text:
            groups.append([])
            continue
        a = ta.encode(" " + text, add_special_tokens=False)
        b = tb.encode(text)
        bytes_a = [bytes(decode[c] for c in t) for t in a.tokens]
        bytes_b = [piece(tb.id_to_piece(i)) for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            groups.append([])
            continue
        ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
        ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            out.append((a.ids[i:x], b[j:y]))
            i, j = x, y
        groups.append(out)
    df = Counter()
    for gs in groups:
        df.update({(x, y) for a, b in gs for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in df.items():
        best[x] = max(best[x], n)
    rows = []
    for (d, _), gs in zip(docs, groups):
        links = [(x, y) for a, b in gs for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        rows.append((d, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links),
                     sum(df[p] == best[p[0]] for p in links), sum(df[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def given(seed, n=40):
    rng = random.Random(seed)
    words = ["hello", "world", "żółw", "naïve", "日本語", "\n", "  ", "\t", "12345", "tokenizers", "don't", "🙂🙂", "</s>", "<|endoftext|>", " ",
             "aaaaaaaaaaaaaaaaaaaaaa", "!!!???", "\r\n\r\n", "ﬁne", "<0x0A>", "Ελλάδα", "ＡＢ"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(n)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, " "), (n + 3, "▁ odd"), (n + 4, "a" * 300), (n + 5, "日本" * 120), (None, "x y"),
            (None, "x y"), (n + 6, "long text without end " * 60), (n + 7, "good start " * 20 + "▁" + " bad end" * 20)]


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_against_definition(spark, monkeypatch, seed, small):
    """Also with parts of 40 characters, ranges of 16 bytes, two neighbours a level and chunks of 100 bytes."""
    if small:
        for name, value in (("PART", 40), ("RANGE", 16), ("FAN", 2), ("CHUNK", 100), ("CHUNK_ROWS", 3)):
            monkeypatch.setattr(fa, name, value)
    docs = given(seed)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA).repartition(3)
    assert got(fa.align(df)) == brute(docs)


def test_parts_tokenize_like_the_whole():
    tokenizers = fa.Tokenizers()
    for seed in range(6):
        for _, text in given(seed):
            if not text or "▁" in text:
                continue
            for size in (1, 7, 50):
                cut = fa.parts(text, size)
                assert " ".join(cut) == text
                pieces = tokenizers.encode(cut)
                whole = tokenizers.encode([text])[0]
                for side in (0, 1):
                    assert np.concatenate([p[side] for p in pieces]).tolist() == whole[side].tolist()


@pytest.mark.parametrize("seed", range(20))
def test_fragments_are_a_monoid(seed):
    """Any bracketing gives the same open ends and the same groups."""
    rng = random.Random(seed)
    sizes = [[rng.randint(1, 4) for _ in range(60)] for _ in range(2)]
    ends = [np.cumsum(s) for s in sizes]
    ends = [e[e <= min(x[-1] for x in ends)] for e in ends]
    a, b = (np.arange(len(e)) + 1000 * i for i, e in enumerate(ends))
    found = [f for _, f, *_ in fa.fragments(a, b, *ends, rng.choice([2, 5, 9]))]

    def fold(fs):
        if len(fs) == 1:
            return fs[0], []
        at = rng.randint(1, len(fs) - 1)
        (x, gx), (y, gy) = fold(fs[:at]), fold(fs[at:])
        both, group = x.then(y)
        return both, gx + gy + ([group] if group else [])

    plain = lambda f, gs: ([z.tolist() for z in (*f.prefix, *f.suffix)], f.first,
                           sorted((g[0], g[1].tolist(), g[2].tolist()) for g in gs))
    assert len({str(plain(*fold(found))) for _ in range(8)}) == 1


def test_wide_groups():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 300), rng.integers(0, 50, 200)
    u, pair, times = fa.linked(a, b, np.array([100, 200]), np.array([150, 50]), np.array([0, 1]))
    want = Counter()
    for k, (x, y) in enumerate(((a[:100], b[:150]), (a[100:], b[150:]))):
        want.update((k, int(i) << 16 | int(j)) for i in x for j in y)
    assert dict(zip(zip(u.tolist(), pair.tolist()), times.tolist())) == want


def test_empty(spark):
    assert fa.align(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    df = op11_fragment_alignment(spark, SF)
    assert df.columns == COLUMNS
    assert got(df) == brute(docs)
