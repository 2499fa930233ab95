"""Round 3, F9: a price text is cleaned once."""

from pyspark.sql import functions as F

from flatwatch.config import PORTAL_A
from flatwatch.functions.text import to_double
from flatwatch.operators.quality import price_status


def test_price_text_is_cleaned_once(spark):
    texts = [None, "", "Zapytaj o cenę", "Zapytaj o cenę", "do uzgodnienia", "1 234,50 zł/mc", "  12 €", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(price_status(F.col("t"), PORTAL_A).alias("s"))
    assert [r.s for r in out.collect()] == ["missing", "unparseable", "ask", "ask", "unparseable", "ok", "ok", "ok"]
    assert out._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 1


def test_numbers_with_white_space_at_their_ends(spark):
    cases = {" 1.5 ": 1.5, " -2 ": -2.0, "\n.5 ": 0.5, "1 2": None, " ": None, "1d": None, "+7.\x85": 7.0, "": None, "3\x1c\n": 3.0}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.d for r in df.select("t", to_double(F.col("t")).alias("d")).collect()} == cases
