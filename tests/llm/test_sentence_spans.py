import random
import re
import unicodedata

from flatwatch.llm import sentence_spans as ss

UNSPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u4e00-\u9fff]")


def plain_cut(text):
    """Sentences as lists of (start, end) characters of their words, by reading the text one character at a time;
    stretches over 40 words are left whole."""
    found, word, last = [], None, ""
    letter = lambda c: c.isalnum() or unicodedata.category(c).startswith("M")
    for i, c in enumerate(text):
        if c in " \t\n\v\f\r":
            word = None
            continue
        fresh = letter(c) and (UNSPACED.match(c) or UNSPACED.match(last[:1]) or any(x in "。！？।؟" for x in last[1:]))
        if word is None or fresh:
            word = len(found)
            found.append([i, i])
        found[word][1] = i + 1
        last = c if letter(c) else last + c
    out, own = [], []
    for k, (s, e) in enumerate(found):
        own.append((s, e))
        tail = e
        while tail > s and not letter(text[tail - 1]):
            tail -= 1
        gap = text[e:found[k + 1][0]] if k + 1 < len(found) else "\n"
        if "\n" in gap or any(x in ".!?;:…。！？।؟" for x in text[tail:e]):
            out.append(own)
            own = []
    return out + [own] if own else out


def test_sentence_ends_in_all_scripts():
    rng = random.Random(3)
    pieces = ["go", "now", "3.5", "e.g.", '"end."', "(so!)", "wait…", "yes?»", "-", "...", "日本", "語。", "「はい」", "文。」次", "ไทย", "हिन्दी।", "مرحبا؟", "Дом.", "é"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) + rng.choice([" ", " ", "  ", "\n", "", " \n "]) for _ in range(rng.randint(0, 30)))
        want = plain_cut(text)
        if any(len(x) > ss.LONGEST for x in want):
            continue
        starts, ends, first = ss.sentences(text.encode())
        at = lambda i: len(text[:i].encode())
        assert [(at(s), at(e)) for x in want for s, e in x] == list(zip(starts.tolist(), ends.tolist()))
        assert first.tolist() == [sum(map(len, want[:k])) for k in range(len(want))]
    # a sentence of forty words is one
    forty = " ".join(["word"] * 39) + " end."
    assert len(ss.sentences((forty + " " + forty).encode())[2]) == 2


def test_scripts_without_spaces(spark):
    rng = random.Random(5)
    def sentence(n=12):
        return "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n)) + "。"
    shared = "".join(sentence() for _ in range(5))
    plain = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(80))               # no sentence ends at all
    rows = [(1, sentence() + shared + sentence()), (2, sentence() + shared + sentence()), (3, sentence() + sentence()),
            (4, sentence() + plain), (5, sentence() + plain)]
    got = {r.doc_id: r.text for r in ss.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    given = dict(rows)
    assert {i: got[i] for i in (1, 3, 4)} == {i: given[i] for i in (1, 3, 4)}
    assert got[2] == given[2].replace(shared, "") and len(got[5]) < 40


def plain(rows, run=3, min_words=15):
    """{(id, text): kept text} by a dictionary of word runs."""
    def units(text):
        raw = (text or "").encode()
        starts, ends, first = ss.sentences(raw)
        words = [raw[s:e] for s, e in zip(starts, ends)]
        cuts = [*first.tolist(), len(words)]
        return raw, starts, [words[a:b] for a, b in zip(cuts, cuts[1:])], cuts

    seen, gone = {}, {}
    order = sorted({(r[0] is not None, r[0] or 0, r[1], r[2]) for r in rows}, key=lambda x: x[:3])
    for _, i, key, text in order:
        _, _, parts, _ = units(text)
        spans = []
        for a in range(len(parts)):
            b = a + run
            while b <= len(parts) and sum(map(len, parts[a:b])) < min_words:
                b += 1
            if b <= len(parts):
                spans.append((a, b))
        if spans and spans[-1][1] < len(parts):
            spans.append((max(a for a in range(len(parts)) if a + run <= len(parts) and sum(map(len, parts[a:])) >= min_words), len(parts)))
        for a, b in spans:
            h = tuple(w.lower() for p in parts[a:b] for w in p)
            if h in seen:
                gone.setdefault((i, key), set()).update(range(a, b))
            else:
                seen[h] = (i, key, a)
    out = {}
    for _, i, key, text in order:
        raw, starts, parts, cuts = units(text)
        ends = [*(int(starts[c]) for c in cuts[1:-1]), len(raw)] if parts else []
        begins = [int(starts[c]) for c in cuts[:-1]] if parts else []
        drop = gone.get((i, key), set())
        head = raw[:begins[0]] if begins else raw
        out[i, key] = (head + b"".join(raw[s:e] for k, (s, e) in enumerate(zip(begins, ends)) if k not in drop)).decode()
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ti", "on", "re", "é", "an", "st"]) for _ in range(rng.randint(1, 4)))
    sentence = lambda k: " ".join(word() for _ in range(k)) + rng.choice([". ", ".\n", ", ", " "])
    passages = ["".join(sentence(rng.randint(3, 18)) for _ in range(6)) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = [sentence(rng.randint(2, 20)) for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        out.append("".join(parts))
    return out, passages


def test_against_a_dictionary(spark):
    texts, passages = corpus(4, 60)
    texts += ["", "   ", "word", texts[3], texts[3].upper(), texts[5]]
    rows = [(i * 7 % 71, t) for i, t in enumerate(texts)] + [(None, texts[8]), (None, None)]
    rows += rows[10:12]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = [(r.doc_id, r.k, r.text) for r in df.withColumn("k", ss.version("doc_id", "text")).collect()]
    want = plain(keyed)
    got = ss.dedup_sentences(df).withColumn("k", ss.F.lit(0)).collect()
    assert len(got) == len(rows)
    assert sorted(t for t in (r.text for r in got) if t is not None) == sorted(
        want[i or 0, k] for i, k, t in keyed if t is not None)
    assert sum(r.text is None for r in got) == 1
    assert any(r.n_removed for r in got)
    source = {}
    for i, t in rows:
        source.setdefault(i, []).append(t)
    for r in got:
        if len(source[r.doc_id]) == 1 and r.text is not None:
            raw, end, kept = source[r.doc_id][0].encode(), 0, b""
            for s in r.removed_spans:
                kept, end = kept + raw[end:s.start], s.end
            assert (kept + raw[end:]).decode() == r.text


def test_a_passage_inside_sentences_is_cut(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfghjklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))             # no punctuation at all
    fill = lambda: " ".join(word() for _ in range(80))
    df = spark.createDataFrame([(i, f"{fill()} {passage} {fill()}") for i in range(6)] + [(9, fill())], "doc_id long, text string")
    got = {r.doc_id: r for r in ss.dedup_sentences(df).collect()}
    assert got[0].n_removed == 0 and got[9].n_removed == 0
    for i in range(1, 6):
        left = sum(w in got[i].text.split() for w in passage.split())
        assert got[i].n_removed > 0 and left < 32


def test_clauses_of_all_scripts():
    parts = lambda text: len(ss.sentences(text.encode())[2])
    assert parts("one two, three four, five (six), seven.") == 4 and parts("costs 1,234 or 5,6 in all") == 1
    assert parts("一二、三四，五六。") == 3 and parts("واحد، اثنان، ثلاثة") == 3


def test_passages_of_fifty_words_in_prose(spark):
    """A passage of 51 to 60 words, put between any two words of a text, is found by the clauses it holds whole."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bcdfghjklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    def prose(n):
        out, clause, left = [], rng.randint(4, 9), rng.randint(16, 30)
        for _ in range(n):
            clause, left = clause - 1, left - 1
            out.append(word() + ("." if not left else "," if not clause else ""))
            clause, left = clause if clause > 0 and left else rng.randint(4, 9), left or rng.randint(16, 30)
        return out
    rows, passages = [], [prose(rng.randint(51, 60)) for _ in range(40)]
    for i, passage in enumerate(passages):
        for k in (2 * i, 2 * i + 1):
            text = prose(120)
            at = rng.randint(0, len(text))
            rows.append((k, " ".join(text[:at] + passage + text[at:])))
    got = {r.doc_id: r for r in ss.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = 0
    for i, passage in enumerate(passages):
        assert got[2 * i].n_removed == 0
        old, new = dict(rows)[2 * i + 1].split(), got[2 * i + 1].text.split()
        lost = len(old) - len(new)
        assert lost <= len(passage)
        found += 2 * lost > len(passage)
    assert found >= 38


def test_clashing_names_empty_table_and_stage(spark):
    text = "one two three four five. six seven eight nine ten. eleven twelve thirteen fourteen fifteen. sixteen."
    df = spark.createDataFrame([(1, text, 7, "a"), (2, text + " And more words here.", 8, "b"), (3, text, 9, "c"), (4, None, None, None)],
                               "doc_id long, text string, n_chars long, n_removed string")
    out = ss.dedup_sentences(df)
    assert out.columns == ["doc_id", "text", "n_chars", "removed_spans", "n_sentences", "n_removed"]
    stage = ss.stage_sentence_spans(df)
    rows = {r.doc_id: r for r in stage.collect()}
    assert stage.columns == df.columns and set(rows) == {1, 2, 4}
    assert rows[1].text == text and rows[1].n_chars == 7 and rows[4].text is None
    assert rows[2].n_chars == len(rows[2].text) < len(text)
    empty = spark.createDataFrame([], df.schema)
    assert ss.dedup_sentences(empty).count() == 0


def test_very_long_text(spark):
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(50_000))
    df = spark.createDataFrame([(1, text), (2, "x. " + text)], "doc_id long, text string")
    got = {r.doc_id: r for r in ss.dedup_sentences(df).collect()}
    assert got[1].text == text and len(got[2].text) < 400


def test_registered_query(spark):
    """The query over a whole table: what it cuts is what a dictionary of runs cuts."""
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, 0, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain(docs)
    got = {r.doc_id: r for r in ss.op10_sentence_spans(spark, sf).collect()}
    assert len(got) == len(docs) and {i: r.text for i, r in got.items()} == {i: want[i, 0] for i, _, _ in docs}
    assert any(r.n_removed for r in got.values())
