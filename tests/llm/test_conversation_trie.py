import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from flatwatch.llm import conversation_trie as ct
from flatwatch.llm.conversation_trie import op13_conversation_trie

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, path string, part int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda k: (k[0], k[1], hashlib.md5(f"{len(k[1])}:{k[1]}:{k[2]}".encode()).digest()))]
           for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        ((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
          hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(n)))).encode()).hexdigest())
         for n, m in members.items()), key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def given(seed, n=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = rng.choice([i, 100 + i % 7, 200 * (i % 3)])
        say = rng.choice(["a", "bb", "żółw", None, "", "𝔘x"])
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", None, "assistant"]),
                         say if rng.random() < 0.7 else rng.choice("xyz")))
    return rows


@pytest.mark.parametrize("opens", ["()", "(())()", "((()())(()))()", "(" * 300 + ")" * 300, "()" * 400,
                                   "(" + "(()())" * 90 + ")" + "(" * 70 + "()" * 70 + ")" * 70])
def test_findclose(opens):
    bits = np.array([c == "(" for c in opens])
    want, stack = {}, []
    for i, c in enumerate(opens):
        if c == "(":
            stack.append(i)
        else:
            want[stack.pop()] = i
    at = np.array(sorted(want))
    assert ct.Parentheses(bits).findclose(at).tolist() == [want[i] for i in at]


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_against_plain_trie(spark, monkeypatch, seed, small):
    """Also with records of two turns, shards of three and digests of two ids: all spines are shared then."""
    if small:
        for name, value in (("BLOCK", 2), ("SHARD", 3), ("IDS", 2)):
            monkeypatch.setattr(ct, name, value)
    rows = given(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    assert got(ct.conversation_trie(df)) == brute(rows)


def test_one_long_conversation_and_copies(spark):
    """A conversation of a third of all rows is split over tasks; copies end at one node; a base without turns left."""
    rows = [(300, t, "user", f"t{t}") for t in range(700)]
    rows += [(400 + i, t, "user", f"u{t}") for i in range(90) for t in range(4)]
    rows += [(None, 0, "user", "left out"), (999, None, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(ct.conversation_trie(df)) == brute(rows)


def test_empty(spark):
    assert ct.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = op13_conversation_trie(spark, SF)
    assert df.columns == COLUMNS
    assert got(df) == brute(rows)
