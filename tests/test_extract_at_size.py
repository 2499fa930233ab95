"""Round 3, F1 to F3 and F8: posts are read in Arrow batches, with the results of the JVM expressions."""

from pyspark.sql import functions as F

from flatwatch.config import PORTAL_A, PORTAL_B
from flatwatch.functions.markup import elements, ranges, scan, tag_reader, tokens
from flatwatch.operators.extract import extract_fields, extract_posts, split_containers

MARKUP = [
    '<article title="x > y" class="a b">p<article class="x">i</article>q</article >z', "<SPAN CLASS=\"a\">u</SPAN><span data-x=\"q class='a'\">n</span>",
    "<div class='a'>1<div class=a>2</div>3</div>", "<div><span class=a>1200<b>x</div>y</span>", "<div class=a><p>never <div class='b a'>ended</div>",
    "<script>'<span class=a>'</script><!-- <span class=a>x</span> --><br class=a><span class=a>ok</span></br></></ x>", "<div class=a/><span class='a'/>x",
    "5 < 6 i 7 > 3", "<", "<>", "<!doctype html>x", "<!-- open <div class=a>", "<script>x<div class=a>y", "<a b='", "", "<DIV Class=a>\x85 ł\U0001f600</DIV>"]


def test_ranges_are_those_of_the_expressions(spark):
    selectors = [("div", "a"), ("span", ("a", "b c")), ("div", None)]
    df = spark.createDataFrame(list(enumerate(MARKUP)), "i int, h string").select("i", tokens(F.col("h")).alias("t"))
    for ci in (True, False):
        read = tag_reader(selectors, ci)
        for r in df.select("i", "t", elements(F.col("t"), selectors, ci).alias("e")).collect():
            assert scan(MARKUP[r.i]) == r.t
            assert ranges(r.t, read) == [tuple(x) for x in r.e], (ci, MARKUP[r.i])


def test_one_pass_gives_what_the_two_steps_give(spark):
    a = ('<article class="css-1rtqihe es62z2j18"><h3 class="css-1rhznz4 es62z2j13">T <b>1</b></h3><span class="css-s8wpzb eclomwz2">5 zł</span>'
         '<span class="css-s8wpzb eclomwz2">3</span></article><article class="css-e6zjf7 es62z2j18">bare</article>')
    b = '<div class="css-1apmciz"><p class="css-wpfvmn-Text eu5v0x0">7 zł</p></div>'
    pages = spark.createDataFrame([("s", "sell", 1, a + b), ("s", None, 2, None), ("s", "sell", None, ""), ("s", "rent", 4, b + a)],
                                  "source string, type string, page long, html string")
    keys = ("source", "type", "page", "pos")
    for cfg in (PORTAL_A, PORTAL_B):
        one = extract_posts(pages, cfg)
        two = extract_fields(split_containers(pages, cfg), cfg)
        assert one.columns == two.columns == [*keys, "title_html", "price_html", "location_html", "spans_html", "area_html"]
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
        assert "MapInArrow" in one._jdf.queryExecution().executedPlan().toString()
    got = {(r.page, r.pos): r for r in extract_posts(pages, PORTAL_A).collect()}
    assert set(got) == {(1, 0), (1, 1), (4, 0), (4, 1)}
    assert got[1, 0].title_html == "T <b>1</b>" and got[1, 0].spans_html == ["5 zł", "3"] and got[1, 1].spans_html == []
    nothing = extract_fields(spark.createDataFrame([(1, None)], "k int, body array<string>"), PORTAL_A, ("k",)).first()
    assert nothing.title_html is None and nothing.spans_html is None
