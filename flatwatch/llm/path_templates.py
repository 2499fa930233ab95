"""URL filter by a tree of path templates.

Below each host the tree grows by one path segment a round. At a node, segment values that are rare there (fewer than
``min_count`` urls or less than ``min_share`` of the node's) are variable and become ``*``. The other values are
branches; those whose labelled urls don't differ from the node's by a test of proportions are merged into one branch
``+``. A url's template is its way through the tree. A template is rejected if its labelled purity, smoothed towards
its host's, which is smoothed towards that of all urls, is below ``min_purity``.

Counts aggregate on the map side. Only values that are not rare (fewer than ``1 / min_share`` at a node) and templates
are joined back to the urls, on (node, value, salt): each url has one of 64 salts, and a value or template has a
row for every salt among its urls, so those of a hot host are dealt out and never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatwatch.llm.common import each_salt, salted, salts_seen, table
from flatwatch.session import materialize

#: The driver's list: (action, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
    or the end. Both are empty for a null url or one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, action) of the longest rule that fits the host or a domain above it and the path's start."""
    name = action = F.lit(None).cast("string")
    for act, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name, action = F.when(fits, F.lit(domain + prefix)).otherwise(name), F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def smoothed(good: Column, n: Column, prior: Column, weight: float) -> Column:
    return (good + weight * prior) / (n + F.lit(weight))


def templates(urls: DataFrame, min_count: int = 20, min_share: float = 0.01, z: float = 3.0,
              max_depth: int | None = None) -> DataFrame:
    """``urls`` (host, path, good: boolean, null without label, and others) plus ``template``.

    The tree grows until no node has ``min_count`` urls that go on: below, every value is rare, so all that is left of a
    path is ``*`` by segment. With a ``max_depth``, segments beyond it make one last branch ``**``. Empty segments don't
    count. An empty path has the template ``/``.
    """
    own = [c for c in urls.columns if c != "template"]
    rows = urls.select(*own, F.filter(F.split("path", "/"), lambda s: s != "").alias("__parts"), F.lit("").alias("template"))
    rows = materialize(salted(rows), "url-tree")
    n, good = F.count(F.lit(1)), F.sum(F.col("good").cast("long"))
    depth = 0
    while depth != max_depth:
        longer = rows.filter(F.size("__parts") > depth)
        if longer.groupBy("host", "template").agg(n.alias("n")).filter(F.col("n") >= min_count).isEmpty():
            rest = F.repeat(F.lit("/*"), F.greatest(F.size("__parts") - depth, F.lit(0)))
            if max_depth is not None:
                kept = F.least(F.size("__parts"), F.lit(max_depth)) - depth
                rest = F.concat(F.repeat(F.lit("/*"), F.greatest(kept, F.lit(0))), F.when(F.size("__parts") > max_depth, "/**").otherwise(""))
            rows = rows.withColumn("template", F.concat("template", rest))
            break
        here = longer.withColumn("__value", F.col("__parts")[depth])
        values = here.groupBy("host", "template", "__value").agg(
            n.alias("n"), F.count("good").alias("m"), good.alias("g"), salts_seen().alias("__salts"))
        nodes = values.groupBy("host", "template").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m"), F.sum("g").alias("all_g"))
        p = F.col("all_g") / F.col("all_m")
        gap = F.abs(F.col("g") - F.col("m") * p)
        same = F.coalesce(gap <= z * F.sqrt(F.col("m") * p * (1 - p)), F.lit(True))
        rare = (F.col("n") < min_count) | (F.col("n") < min_share * F.col("all_n"))
        branch = (values.join(nodes, ["host", "template"]).filter(~rare)
                  .select("host", "template", "__value", F.when(same, "+").otherwise(F.col("__value")).alias("__branch"),
                          each_salt(F.col("__salts")).alias("__salt")))
        grown = (rows.withColumn("__value", F.get("__parts", F.lit(depth)))
                 .join(branch, ["host", "template", "__value", "__salt"], "left"))
        step = F.when(F.col("__value").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("__branch", F.lit("*"))))
        tail = F.when(F.size("__parts") > max_depth, F.lit("/**")).otherwise("") if depth + 1 == max_depth else F.lit("")
        rows = materialize(grown.select(*own, "__parts", "__salt", F.concat("template", step, tail).alias("template")), "url-tree")
        depth += 1
    return rows.select(*own, F.when(F.col("template") == "", "/").otherwise(F.col("template")).alias("template"))


def judge(urls: DataFrame, rules=RULES, min_purity: float = 0.5, weight: float = 10.0, **options) -> DataFrame:
    """``urls`` (url; good: boolean or null; others) plus host, path, rule, template, purity and verdict.

    The longest rule that fits decides; else the purity of the url's template. Without any label every template is
    pure. Null urls and such without ``://`` have an empty host and path and the template ``/``. Repeated rows are judged
    each; columns of ``urls`` named like a new one are replaced. An empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    made = ("host", "path", "rule", "action", "template", "purity", "verdict")
    own = [c for c in urls.columns if c not in made]
    name, action = matched_rule(F.col("host"), F.col("path"), rules)
    split = urls.select(*own, host.alias("host"), path.alias("path"))
    rows = materialize(salted(templates(split.select("*", name.alias("rule"), action.alias("action")), **options)), "url-templates")
    counts = rows.groupBy("host", "template").agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("g"),
                                                  salts_seen().alias("__salts"))
    counts = materialize(counts, "url-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()
    base = F.lit((total["g"] + 1) / (total["n"] + 1) if total["n"] else 1.0)
    hosts = counts.groupBy("host").agg(smoothed(F.sum("g"), F.sum("n"), base, weight).alias("host_purity"))
    pure = (counts.join(hosts, "host")
            .select("host", "template", smoothed(F.col("g"), F.col("n"), F.col("host_purity"), weight).alias("purity"),
                    each_salt(F.col("__salts")).alias("__salt")))
    verdict = F.coalesce("action", F.when(F.col("purity") < min_purity, "block").otherwise("allow"))
    return (rows.join(pure, ["host", "template", "__salt"], "left")
            .select(*own, "host", "path", "rule", "template", "purity", verdict.alias("verdict")))


def op4_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages. A page is labelled by the document whose id ends its path: good if of quality and not toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = (table(spark, sf_dir, "labels").groupBy("doc_id")
              .agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good")))
    number = F.regexp_extract(host_and_path(F.col("url"))[1], "/([0-9]{1,18})(?:\\.[a-z]+)?/?$", 1)
    urls = pages.withColumn("doc_id", F.when(number != "", number).cast("long"))
    return judge(urls.join(labels, "doc_id", "left").select("page_id", "url", "good")).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")
