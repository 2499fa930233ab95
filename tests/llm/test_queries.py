"""The registered queries: SQL where there is one, and the pipeline against a plain version of its stages."""

import os

import duckdb

import __spark_entry__ as E
import corpus_pipeline as cp
from flatwatch.llm import qgram_decontam as qd
from flatwatch.llm import sentence_spans as ss
from flatwatch.llm import simhash_ball as sb
from flatwatch.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

#: The production classifier needs more labels than the smallest tables have.
LARGER = "/root/testdata/sf0.01"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_sql(spark):
    duck = duckdb.connect()
    for name in os.listdir(SF):
        duck.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    for name, sql in ORACLES.items():
        want = duck.sql(sql)
        got = QUERIES[name](spark, SF).select(*want.columns).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r.doc_id: r.text for r in cp.quality(spark, docs, LARGER).collect()}
    assert 0 < len(rows) < docs.count()
    fps = {i: sb.fingerprint(t.encode()) for i, t in rows.items()}
    group = {i: i for i in rows}
    for i in sorted(rows):
        for j in sorted(rows):
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    rows = {i: rows[i] for i in rows if group[i] == i}
    seen, cut = set(), {}
    for i in sorted(rows):
        raw = rows[i].encode()
        new, _, n, gone = ss.strip(raw, seen, 3, 15)
        seen |= set(ss.runs(raw, 3, 15)[0])
        if not 0 < gone == n:
            cut[i] = new.decode()
    index = qd.Index(items, 8, 0.1)
    kept = {i: t for i, t in cut.items() if not index.search(t)}
    got = cp.run(spark, LARGER).collect()
    assert {r.doc_id for r in got} == set(kept) and len(kept) < len(cut)
    from flatwatch.llm.token_pieces import encoder
    encode = encoder()
    assert {i: sum(r.length for r in got if r.doc_id == i) for i in kept} == {i: len(encode(t)) + 1 for i, t in kept.items()}
    stages = dict(cp.STAGES)
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs, LARGER).columns == docs.columns
