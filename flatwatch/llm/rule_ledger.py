"""Quality rules as a bitmask ledger, in DataFrame expressions only.

Every rule is evaluated once per document: the ledger keeps the measurements and one integer whose bit k is set if rule
k failed. A policy is a named set of rules, that is a mask; verdicts of any policy and the effect of leaving a rule out
come from bit operations on the ledger, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatwatch.llm.common import WORD_SPACE, table

#: Words of a window, for the share of words in repeated windows.
WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules in order of their bits, over the measurements of :func:`measured`. Shares have the word or line count below."""
    n, c = F.col("n_words"), F.col
    return [
        Rule("few_words", n < 20),
        Rule("repeated_words", 100 * c("n_repeat_words") > 30 * n),
        Rule("repeated_lines", (c("n_dup_lines") > 2) & (100 * c("n_dup_lines") > 30 * c("n_lines"))),
        Rule("symbols", 100 * c("n_symbols") > 10 * n),
        Rule("short_words", c("word_chars") < 2 * n),
        Rule("long_words", c("word_chars") > 40 * n),
    ]


#: Policies by version: the rules they apply.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "repeated_lines", "symbols"),
    "v2": ("few_words", "repeated_words", "repeated_lines", "symbols", "short_words", "long_words"),
}
DEFAULT_POLICY = "v2"


def mask(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {r.name: k for k, r in enumerate(rules())}
    return sum(1 << bits[name] for name in set(names))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more; windows are compared by 64-bit hashes.

    Texts without a repeated window, nearly all, end at the count of distinct hashes. Otherwise hashes are sorted with
    their places, places beside an equal hash are kept, and the union of their windows is summed in order.
    """

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct(
            (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def places(pairs: Column) -> Column:
        hash_at = lambda k: F.get(pairs, k)["h"]
        near = F.transform(pairs, lambda p, k: F.when((p["h"] == hash_at(k - 1)) | (p["h"] == hash_at(k + 1)), p["i"]))
        return F.array_sort(F.filter(near, lambda i: i.isNotNull()))

    def union(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(pairs, lambda p: covered(places(p))))

    def windows(hashed: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1)),
                               lambda i: F.xxhash64(F.slice(hashed, i, WINDOW))), union)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows))


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the measurements (long): n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words are runs of anything but white space (space and \\x09 to \\x0D); null counts as an empty text. A line counts if
    it has a word; a repeated line is one equal to an earlier line of the text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_replace(t, f"^[{WORD_SPACE}]+|[{WORD_SPACE}]+$", "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{WORD_SPACE}]+"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WORD_SPACE}]"))
    by_words = let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    found = docs.select(
        *keep, by_words.alias("__w"), by_lines.alias("__l"),
        F.char_length(F.regexp_replace(t, f"[{WORD_SPACE}]+", "")).alias("__c"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, f"[{SYMBOLS}]+", ""))).alias("__s"))
    return found.select(*keep, F.col("__w.n").cast("long").alias("n_words"), F.col("__c").cast("long").alias("word_chars"),
                        F.col("__s").cast("long").alias("n_symbols"), F.col("__l.n").cast("long").alias("n_lines"),
                        F.col("__l.d").cast("long").alias("n_dup_lines"), F.col("__w.r").cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """:func:`measured` and ``failed`` (long): bit k is set if rule k failed. One row for each row; nothing is shuffled.

    An empty or null text has no words and fails ``few_words``; a rule on shares doesn't fail where nothing is counted.
    Very long texts are measured whole. Columns not in ``keep`` are left behind, so their names can't clash.
    """
    found = measured(docs, text, keep)
    bits = sum((F.when(r.fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules())), F.lit(0))
    return found.withColumn("failed", bits.cast("long"))


def verdict(failed: Column, policy: str | tuple[str, ...] = DEFAULT_POLICY) -> Column:
    """True if no rule of the policy failed."""
    return failed.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(rows: DataFrame, policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(version, rule, n_docs, n_rejected, n_failed, n_only, ever_failed, always_failed) over a ledger.

    ``n_only``: documents that the policy would keep if the rule were left out. ``ever_failed`` and ``always_failed``
    are the names of rules that failed for some and for every document (bitwise or and and over the ledger). The ledger
    is reduced to counts by bit pattern first. An empty ledger gives no rows.
    """
    policies = policies or POLICIES
    names = [r.name for r in rules()]
    patterns = rows.groupBy("failed").count()                          # at most 2 ** len(rules()) rows
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(n).alias("rule"), F.lit(mask(p)).cast("long").alias("all"),
                                         F.lit(mask((n,))).cast("long").alias("bit")) for v, p in policies.items() for n in p]))
    hit, own = F.col("failed").bitwiseAND(F.col("cell.all")), F.col("cell.bit")
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("count"))), F.lit(0))
    listed = lambda bits: F.array(*[F.when(bits.bitwiseAND(F.lit(1 << k).cast("long")) != 0, F.lit(n)) for k, n in enumerate(names)])
    return (patterns.select("failed", "count", cells.alias("cell"))
            .groupBy(F.col("cell.version").alias("version"), F.col("cell.rule").alias("rule"))
            .agg(F.sum("count").alias("n_docs"), count(hit != 0).alias("n_rejected"),
                 count(hit.bitwiseAND(own) != 0).alias("n_failed"), count(hit == own).alias("n_only"),
                 F.bit_or("failed").alias("__any"), F.bit_and("failed").alias("__all"))
            .select("version", "rule", "n_docs", "n_rejected", "n_failed", "n_only",
                    F.array_compact(listed(F.col("__any"))).alias("ever_failed"),
                    F.array_compact(listed(F.col("__all"))).alias("always_failed")))


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: measurements, the base rules' verdict and that of the default policy."""
    found = ledger(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "failed",
                        (~verdict(F.col("failed"), "base")).alias("base_failed"), verdict(F.col("failed")).alias("kept"))


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], chr(1)) AS w
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM p WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
      FROM p LEFT JOIN cov USING (rid)),
f AS (SELECT *, CAST((CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END) AS BIGINT)
        AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, failed,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""
