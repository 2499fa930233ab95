"""Markup that a parser gets right and a pattern does not, rendered by Spark from line items: one small page each.

The variant follows the keys. Every page has a post of portal A's classes; title and price come from the line item, so
SQL can state what has to be found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .testview import table

A1, A2, H3, SPAN = ("css-1rtqihe es62z2j18", "css-e6zjf7 es62z2j18", "css-1rhznz4 es62z2j13", "css-s8wpzb eclomwz2")

#: {T} and {Q} stand for the line item's order and quantity.
VARIANTS = (
    # another article inside, its end tag with a space, a look-alike after the post
    f'<article class="{A1}"><h3 class="{H3}">Lot {{T}}</h3><article class="x">i</article><span class="{SPAN}">{{Q}} zł</span></article >'
    f'<span class="{SPAN}">999 zł</span>',
    # a post inside a post: both are whole
    f'<article class="{A1}"><h3 class="{H3}">Lot {{T}}</h3><article class="{A2}"><h3 class="{H3}">Inner {{T}}</h3>'
    f'<span class="{SPAN}">1{{Q}} zł</span></article><span class="{SPAN}">{{Q}} zł</span></article>',
    # > and a whole tag in quoted values, single quotes
    f"<article title=\"x > y\" data-x=\"<article class='{A2}'>\" class='{A2}'><h3 class='{H3}'>Lot {{T}}</h3>"
    f"<span class='{SPAN}' title='</span>'>{{Q}} zł</span></article>",
    # upper case, spaces around the sign and within the class
    f'<ARTICLE CLASS = "{A1}"><H3 Class="{H3}">Lot {{T}}</h3><SPAN class=" {SPAN.replace(" ", "  ")} ">{{Q}} zł</SPAN></Article>',
    # five levels of one name
    f'<article class="{A1}"><h3 class="{H3}">Lot <h3><h3><h3><h3>{{T}}</h3></h3></h3></h3></h3><span class="{SPAN}">{{Q}} zł</span></article>',
    # an element that its parent ends
    f'<article class="{A1}"><div><span class="{SPAN}">{{Q}} zł<b></div><h3 class="{H3}">Lot {{T}}</h3></article>',
    # classes that are none, hidden markup
    f'<!-- <article class="{A1}">old</article> --><script>"<article class=\'{A1}\'>"</script><article class="{A1}">'
    f'<span data-x="q class=\'{SPAN}\'">no</span><h3 class="{H3}">Lot {{T}}</h3><span class="{SPAN}"><br>{{Q}} zł</span></article>',
    # a sign that opens no tag, references without a semicolon
    f'<article class="{A1}"><h3 class="{H3}">Lot 5 < 6 &copy{{T}}</h3><span class="{SPAN}">{{Q}}&nbspzł</span></article>',
)


def variant() -> Column:
    return F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(VARIANTS))).cast("int")


def edge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, l_quantity, html) of every line item."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    html = F.element_at(F.array(*[F.lit(v) for v in VARIANTS]), variant() + 1)
    html = F.replace(F.replace(html, F.lit("{T}"), F.col("l_orderkey").cast("string")), F.lit("{Q}"), F.col("l_quantity").cast("int").cast("string"))
    return li.withColumn("html", F.concat(F.lit("<!DOCTYPE html><html><body><main>"), html, F.lit("</main></body></html>")))


def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, text): named and numeric references with what follows them, by line item."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    key = F.col("l_orderkey").cast("string")
    forms = [F.concat(F.lit("&copy"), key), F.concat(F.lit("&notit;"), key), F.concat(F.lit("&frac12"), key), F.concat(key, F.lit("&nbspzł")),
             F.concat(F.lit("&#"), (F.col("l_linenumber") + 64).cast("string"), F.lit(";"), key), F.concat(F.lit("&amp;lt;"), key, F.lit("&ltx")),
             F.concat(F.lit("&NotEqualTilde;&nosuch;&"), key), F.concat(F.lit("&Aacutex=&oacute="), key)]
    return li.select("l_orderkey", "l_linenumber", F.element_at(F.array(*forms), variant() + 1).alias("text"))
