"""The one-pass scan: token ends, element ranges, and references as HTML decodes them."""

import html
import html.entities

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flatwatch.functions.html import attribute_of, element_text, find_all_inner, find_inner, strip_tags, unescape
from flatwatch.functions.markup import tokens

CASES = [
    # (markup, name, class, inner markup of all matches)
    ('<article title="x > y" class="a b">p<article class="x">i</article>q</article >z', "article", "a b", ['p<article class="x">i</article>q']),
    ("<SPAN CLASS=\"k\">u</SPAN><span data-x=\"q class='k'\">n</span>", "span", "k", ["u"]),
    ("<div class='c'>1<div class=c>2</div>3</div>", "div", "c", ["1<div class=c>2</div>3", "2"]),
    ('<h3 class="t">a<h3>b<h3>c<h3>d<h3>e</h3></h3></h3></h3>deep tail</h3>', "h3", "t", ["a<h3>b<h3>c<h3>d<h3>e</h3></h3></h3></h3>deep tail"]),
    ("<div><span class=k>1200<b>x</div>y</span>", "span", "k", ["1200<b>x"]),
    ("<script>'<span class=k>'</script><!-- <span class=k>x</span> --><br class=k><span class=k>ok</span>", "span", "k", ["ok"]),
    ('<span class="a  b">t</span><span class=" a b ">u</span><span class="a b c">v</span>', "span", "a b", ["t", "u"]),
    ("<p class=k>never ended", "p", "k", ["never ended"]),
    ("</p></p><p class=k>x</p>", "p", "k", ["x"]),
    ("<p class=k title='a", "p", "k", []),
    ("", "p", "k", []),
]


def test_hand_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, h string")
    for i, (_, name, cls, want) in enumerate(CASES):
        got = df.filter(F.col("i") == i).select(find_all_inner(F.col("h"), name, cls, ci=True)).first()[0]
        assert got == want, CASES[i]


def test_nothing_is_lost_and_text_with_signs(spark):
    texts = [c[0] for c in CASES] + ["5 < 6 i 7 > 3", "<", "a<", "<>", "</>", "<!doctype html>x", "<!-- open", "<script>x", "<a b='", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in df.select("i", F.array_join(tokens(F.col("t")), "").alias("j"), strip_tags(F.col("t")).alias("s")).collect()}
    assert [got[i].j for i in range(len(texts))] == texts
    at = texts.index("5 < 6 i 7 > 3")
    assert got[at].s == "5 < 6 i 7 > 3"


def test_depth_without_limit(spark):
    deep = "<b>" * 2000 + "x" + "</b>" * 2000
    df = spark.createDataFrame([(f"<div class=a>{deep}<i>end</i></div><div class=a>2</div>",)], "h string")
    r = df.select(element_text(find_inner(F.col("h"), "div", "a")), attribute_of(F.col("h"), "DIV", "class", ci=True)).first()
    assert tuple(r) == ("xend", "a")


def test_every_name_with_what_follows(spark):
    """All names of HTML, with a letter, digit, sign or semicolon after them; also not finished by one."""
    texts = [f"&{n}{x}" for n in html.entities.html5 for x in ("", "z", "1", "=", ";")]
    texts += ["&notit;", "&copy2024", "1200&nbspzł", "&am<b>p;</b>", "&ampamp;", "&", "&;", "&#;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    got = {r.t: r.u for r in df.select("t", unescape(F.col("t")).alias("u")).collect()}
    assert {t: u for t, u in got.items() if u != html.unescape(t)} == {}
    one = spark.createDataFrame([("&am<b>p;</b>x",)], "t string").select(element_text(F.col("t"))).first()[0]
    assert one == "&amp;x"


class Ranges:
    """The same rules by a plain parser of well-formed tags."""

    def __init__(self, parts):
        self.open, self.found = [], []
        for i, (kind, name) in enumerate(parts):
            if kind == "start":
                self.open.append((name, i))
            elif kind == "end" and any(n == name for n, _ in self.open):
                while True:
                    n, at = self.open.pop()
                    self.found.append((n, at, i))
                    if n == name:
                        break
        for n, at in self.open:
            later = [i for i, (kind, name) in enumerate(parts) if kind == "end" and name == n and i > at]
            self.found.append((n, at, later[0] if later else len(parts)))


PART = st.tuples(st.sampled_from(["start", "end", "text"]), st.sampled_from(["a", "b", "c"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pages=st.lists(st.lists(PART, min_size=1, max_size=25), min_size=30, max_size=30))
def test_random_nesting(spark, pages):
    render = {"start": "<{}>", "end": "</{}>", "text": "{}\n"}
    # texts are kept apart by a comment, so that every part is a token
    markup = ["".join(render[k].format(n) + ("<!-- -->" if k == "text" else "") for k, n in p) for p in pages]
    df = spark.createDataFrame(list(enumerate(markup)), "i int, h string")
    got = {r.i: r.f for r in df.select("i", find_all_inner(F.col("h"), "a").alias("f")).collect()}
    for i, p in enumerate(pages):
        want = []
        for n, start, end in sorted(Ranges(p).found, key=lambda f: f[1]):
            if n == "a":
                want.append("".join(render[k].format(m) + ("<!-- -->" if k == "text" else "") for k, m in p[start + 1:end]))
        assert got[i] == want
