"""DuckDB SQL for every registered query (tables are the driver's parquet views).

Where a query parses rendered text, the oracle states the expected value straight from the columns the text
was rendered from (ground truth), not by repeating the cleaning steps.
"""

from __future__ import annotations

from .testview import ASK_NFC, ASK_NFD, SNAPSHOT_DATE, TEST_KEYWORDS, TEST_MAIN_CITIES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


D = f"DATE '{SNAPSHOT_DATE.isoformat()}'"
TYPE_OF_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'rent' WHEN 'F' THEN 'sell' ELSE 'room' END"

LST = """SELECT n_name AS post_city, l_extendedprice AS post_price,
  CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS INTEGER) ELSE l_linenumber END AS post_rooms,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN CAST(NULL AS DOUBLE)
       WHEN l_returnflag <> 'R' AND l_quantity = 1 THEN CAST(0 AS DOUBLE)
       ELSE l_quantity * 2.5 END AS post_sqmetrage,
  o_orderpriority AS post_title,
  CAST(date_trunc('week', o_orderdate) AS DATE) AS download_date,
  """ + TYPE_OF_STATUS + """ AS type,
  CASE WHEN l_returnflag = 'R' THEN 'portal_b' ELSE 'portal_a' END AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_URGENT = " OR ".join(f"contains(post_title, {_q(k)})" for k in TEST_KEYWORDS)

ENR = """SELECT *,
  CASE WHEN source = 'portal_b' AND type = 'room' THEN '0'
       WHEN post_sqmetrage < 30 THEN '<30'
       WHEN post_sqmetrage >= 30 AND post_sqmetrage < 50 THEN '30-49'
       WHEN post_sqmetrage >= 50 AND post_sqmetrage < 75 THEN '50-74'
       WHEN post_sqmetrage >= 75 AND post_sqmetrage <= 100 THEN '75-100'
       ELSE '>100' END AS sqm_bucket,
  CASE WHEN """ + _URGENT + """ THEN 'urgent' ELSE 'normal' END AS urgency,
  CASE WHEN source = 'portal_b' AND type = 'room' THEN CAST(0 AS DOUBLE)
       ELSE post_price / NULLIF(post_sqmetrage, 0) END AS price_per_sqm
FROM (""" + LST + """) lst"""

AGGS = """round(avg(post_price), 0) AS avg_price, min(post_price) AS min_price, max(post_price) AS max_price,
  round(avg(post_rooms), 0) AS avg_rooms, round(avg(post_sqmetrage), 0) AS avg_sqmetrage,
  min(post_sqmetrage) AS min_sqmetrage, max(post_sqmetrage) AS max_sqmetrage,
  round(avg(price_per_sqm), 0) AS avg_price_sqm, min(price_per_sqm) AS min_price_sqm,
  max(price_per_sqm) AS max_price_sqm, count(*) AS number_of_posts"""

CITY_SUMMARY = ("SELECT post_city, type, " + AGGS + ", " + D + " AS download_date FROM (" + ENR +
                ") e WHERE download_date = " + D + " GROUP BY post_city, type")

CITY_SUMMARY_HISTORY = ("SELECT post_city, type, " + AGGS + ", download_date FROM (" + ENR +
                        ") e GROUP BY download_date, post_city, type")

MAIN_CITY_SUMMARY = ("SELECT * FROM (" + CITY_SUMMARY + ") s WHERE post_city IN (" +
                     ", ".join(_q(c) for c in TEST_MAIN_CITIES) + ")")

AVG_MIN_MAX_BY_KEY = """SELECT source, type, round(avg(post_price), 0) AS avg_price, min(post_price) AS min_price,
  max(post_price) AS max_price, round(avg(post_rooms), 0) AS avg_rooms,
  round(avg(post_sqmetrage), 0) AS avg_sqmetrage, min(post_sqmetrage) AS min_sqmetrage,
  max(post_sqmetrage) AS max_sqmetrage
FROM (""" + ENR + ") e GROUP BY source, type"

LISTING_QUALITY = """SELECT source, type, count(*) AS number_of_posts,
  count(*) FILTER (WHERE post_price IS NULL) AS missing_price,
  count(*) FILTER (WHERE post_city IS NULL) AS missing_city,
  count(*) FILTER (WHERE post_sqmetrage IS NULL) AS missing_area,
  count(*) FILTER (WHERE post_sqmetrage = 0) AS zero_area
FROM (""" + ENR + ") e GROUP BY source, type"

POSTS_PER_KEY = "SELECT post_city, source, count(*) AS number_of_posts FROM (" + LST + ") l GROUP BY post_city, source"

AREA_BUCKET_COUNTS = ("SELECT source, type, sqm_bucket, count(*) AS number_of_posts FROM (" + ENR +
                      ") e GROUP BY source, type, sqm_bucket")

URGENCY_COUNTS = ("SELECT type, urgency, count(*) AS number_of_posts FROM (SELECT " + TYPE_OF_STATUS +
                  " AS type, CASE WHEN " + _URGENT.replace("post_title", "o_orderpriority") +
                  " THEN 'urgent' ELSE 'normal' END AS urgency FROM orders) o GROUP BY type, urgency")

PRICE_PER_AREA = ("SELECT post_price, post_sqmetrage, post_price / NULLIF(post_sqmetrage, 0) AS price_per_sqm FROM ("
                  + LST + ") l")

ROOM_DEFAULTS = ("SELECT source, type, sqm_bucket, count(*) AS number_of_posts, min(price_per_sqm) AS min_price_sqm, "
                 "max(price_per_sqm) AS max_price_sqm FROM (" + ENR + ") e GROUP BY source, type, sqm_bucket")

SNAPSHOT_FILTER = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                   "CAST(date_trunc('week', o_orderdate) AS DATE) AS download_date FROM orders "
                   "WHERE CAST(date_trunc('week', o_orderdate) AS DATE) = " + D)

UNION_SOURCES = """SELECT post_title, post_price, post_city,
  CASE WHEN source = 'portal_b' AND type = 'room' THEN CAST(NULL AS DOUBLE) ELSE post_sqmetrage END AS post_sqmetrage,
  CASE WHEN source = 'portal_b' THEN CAST(NULL AS INTEGER) ELSE post_rooms END AS post_rooms,
  download_date, type, source
FROM (""" + LST + ") l"

# ---- rendered texts (same renderings as testview.py) ----------------------------------------------------
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_WHOLE = f"({_CENTS} // 100)"
_AMOUNT = (f"(CASE WHEN {_WHOLE} >= 1000 THEN CAST({_WHOLE} // 1000 AS VARCHAR) || chr(160) || "
           f"lpad(CAST({_WHOLE} % 1000 AS VARCHAR), 3, '0') ELSE CAST({_WHOLE} AS VARCHAR) END "
           f"|| ',' || lpad(CAST({_CENTS} % 100 AS VARCHAR), 2, '0'))")
PRICE_TEXT_A = (f"CASE WHEN l_discount = 0 THEN CASE WHEN l_linestatus = 'O' THEN {_q(ASK_NFC)} ELSE {_q(ASK_NFD)} END "
                f"WHEN l_tax = 0 THEN 'do uzgodnienia' "
                f"ELSE {_AMOUNT} || CASE WHEN l_returnflag = 'A' THEN ' €' ELSE ' zł/mc' END END")
PRICE_TEXT_B = (f"CASE WHEN l_discount = 0 THEN 'Za darmo' ELSE {_AMOUNT} || ' zł' || "
                f"CASE WHEN l_linestatus = 'O' THEN ' do negocjacji' ELSE '' END END")
_NUM_A = "CAST(l_quantity * 2.5 AS VARCHAR)"
AREA_TEXT_A = (f"CASE WHEN l_returnflag = 'A' THEN replace({_NUM_A}, '.', ',') || ' m²' "
               f"WHEN l_returnflag = 'R' THEN ' ' || {_NUM_A} || ' m²' ELSE {_NUM_A} || ' m²' END")
AREA_TEXT_B = ("CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS VARCHAR) "
               "ELSE replace(CAST(l_quantity / 2 AS VARCHAR), '.', ',') || ' m²' END")

PRICE_TEXT_PARSE = (f"SELECT l_orderkey, l_linenumber, {PRICE_TEXT_A} AS price_text, "
                    f"CASE WHEN l_discount = 0 OR l_tax = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST({_WHOLE} AS DOUBLE) END "
                    f"AS post_price FROM lineitem")

PRICE_TEXT_NEGOTIABLE = (f"SELECT l_orderkey, l_linenumber, {PRICE_TEXT_B} AS price_text, "
                         f"CASE WHEN l_discount = 0 THEN CAST(NULL AS DOUBLE) "
                         f"ELSE round(CAST({_CENTS} AS DOUBLE) / 100, 2) END AS post_price FROM lineitem")

ROOMS_FIRST_CHAR = """SELECT l_orderkey, l_linenumber, least(l_linenumber, 5) AS n_spans,
  CASE WHEN least(l_linenumber, 5) IN (3, 4)
       THEN CAST(left(CAST(CAST(floor(l_quantity / 4) AS BIGINT) AS VARCHAR), 1) AS INTEGER) ELSE 0 END AS post_rooms,
  CASE WHEN least(l_linenumber, 5) IN (3, 4)
       THEN CASE WHEN l_returnflag IN ('A', 'R') THEN CAST(NULL AS DOUBLE) ELSE l_quantity * 2.5 END
       ELSE CAST(0 AS DOUBLE) END AS post_sqmetrage
FROM lineitem"""

AREA_PREFIX = (f"SELECT l_orderkey, l_linenumber, {AREA_TEXT_A} AS area_text, "
               "CASE WHEN l_returnflag IN ('A', 'R') THEN CAST(NULL AS DOUBLE) ELSE l_quantity * 2.5 END "
               "AS post_sqmetrage FROM lineitem")

AREA_ROUND_HALF_EVEN = (f"SELECT l_orderkey, l_linenumber, {AREA_TEXT_B} AS area_text, "
                        "CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS DOUBLE) "
                        "ELSE CAST(round_even(l_quantity / 2, 0) AS DOUBLE) END AS post_sqmetrage FROM lineitem")

_PLACES = ("FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
LOCATION_TEXT_A = ("'ul. Długa ' || CAST(c_custkey AS VARCHAR) || ', ' || c_mktsegment || ', ' || "
                   "CASE WHEN c_acctbal >= 0 THEN n_name ELSE lower(n_name) END || ', ' || "
                   "CASE WHEN c_acctbal >= 0 THEN r_name ELSE lower(r_name) END")
LOCATION_TEXT_B = ("CASE WHEN c_acctbal >= 0 THEN n_name || ', ' || c_mktsegment || ' - dzisiaj' "
                   "ELSE ' ' || n_name || '-' || c_mktsegment || ', ' || r_name END")
_DICT = ("SELECT n_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey "
         "UNION SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey")

CITY_DICTIONARY_LOOKUP = f"""WITH places AS (SELECT c_custkey, {LOCATION_TEXT_A} AS location_text {_PLACES}),
dict AS ({_DICT}),
pieces AS (SELECT c_custkey, trim(p.piece) AS piece, p.pos
           FROM places, unnest(string_split(location_text, ',')) WITH ORDINALITY AS p(piece, pos)),
hits AS (SELECT c_custkey, arg_min(piece, pos) AS post_city FROM pieces JOIN dict ON piece = city GROUP BY c_custkey)
SELECT places.c_custkey, location_text, hits.post_city FROM places LEFT JOIN hits ON places.c_custkey = hits.c_custkey"""

CITY_POSITIONAL = (f"SELECT c_custkey, {LOCATION_TEXT_B} AS location_text, "
                   f"trim(split_part(split_part({LOCATION_TEXT_B}, ',', 1), '-', 1)) AS post_city {_PLACES}")

CITY_DICTIONARY = "SELECT DISTINCT city FROM (" + _DICT + ") d WHERE city <> ''"

# ---- pages ---------------------------------------------------------------------------------------------
_LI = r"(?s)<li\b[^>]*>(.*?)</li\s*>"
_HREF = r'(?s)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"'
_A = r"(?s)<a\b[^>]*>(.*?)</a\s*>"
_H1 = r"(?s)<h1\b[^>]*>(.*?)</h1\s*>"
_LANG = r"^[a-z]+://[^/]+/([a-z]{2})/"


def _text(x: str) -> str:
    stripped = f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')"
    out = stripped
    for ent, ch in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&copy;", "©"),
                    ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, {_q(ent)}, {_q(ch)})"
    return out


def _first(text: str, pat: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {_q(pat)}) THEN regexp_extract({text}, {_q(pat)}, 1) END"


_ITEMS = f"""SELECT page_id, regexp_extract(url, {_q(_LANG)}, 1) AS lang, CAST(p.pos - 1 AS INTEGER) AS pos,
  {_first('p.body', _HREF)} AS item_href,
  {_text(_first('p.body', _A))} AS item_text
FROM pages, unnest(regexp_extract_all(html, {_q(_LI)}, 1)) WITH ORDINALITY AS p(body, pos)"""

PAGE_ITEMS = f"SELECT page_id, pos, item_href, item_text FROM ({_ITEMS}) i"

PAGE_ITEMS_SKIP_PROMOTED = f"""SELECT page_id, pos, lang, item_href FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY page_id, pos) AS rn FROM ({_ITEMS}) i) r WHERE rn > 3"""

PAGE_TITLE = f"SELECT page_id, {_text(_first('html', _H1))} AS title FROM pages"

MISSING_PAGES = """SELECT 'web' AS source, lang AS type, doc_id AS page,
  'https://pages.example/' || lang || '/' || CAST(doc_id AS VARCHAR) AS url, lang = 'en' AS required
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id)"""

PAGE_CATALOGUE = """SELECT 'web' AS source, lang AS type, g.page,
  'https://pages.example/' || lang || '/?page=' || CAST(g.page AS VARCHAR) AS url, lang = 'en' AS required
FROM (SELECT lang, min(doc_id) AS lo, max(doc_id) AS hi FROM documents GROUP BY lang) c,
     unnest(generate_series(c.lo, c.hi)) AS g(page)"""

JDBC_ROUND_TRIP = "SELECT n_nationkey, n_name, n_regionkey FROM nation"

SNAPSHOT_REWRITE = ("SELECT o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) "
                    "AS download_date, 'orders' AS source, " + TYPE_OF_STATUS + " AS type FROM orders")

CITY_DICTIONARY_LOOKUP_LARGE = """
WITH d AS (SELECT DISTINCT concat('C', o_custkey % 5000, '-', o_orderkey) AS city FROM orders),
p AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 10 END AS post_key,
             concat('C', o_custkey % 5000, '-', o_orderkey - o_orderkey % 3) AS c1, concat('C', o_custkey % 5000, '-', o_orderkey) AS c2
      FROM orders)
SELECT post_key, concat('ul. X, ', c1, ' , ', c2) AS location_text,
       CASE WHEN c1 IN (SELECT city FROM d) THEN c1 WHEN c2 IN (SELECT city FROM d) THEN c2 END AS post_city
FROM p
"""

ORACLES: dict[str, str] = {
    "city_summary": CITY_SUMMARY,
    "city_summary_history": CITY_SUMMARY_HISTORY,
    "city_summary_history_preagg": CITY_SUMMARY_HISTORY,
    "main_city_summary": MAIN_CITY_SUMMARY,
    "enrich_listings": ENR,
    "area_bucket_counts": AREA_BUCKET_COUNTS,
    "urgency_counts": URGENCY_COUNTS,
    "price_per_area": PRICE_PER_AREA,
    "room_defaults": ROOM_DEFAULTS,
    "snapshot_filter": SNAPSHOT_FILTER,
    "avg_min_max_by_key": AVG_MIN_MAX_BY_KEY,
    "posts_per_key": POSTS_PER_KEY,
    "listing_quality": LISTING_QUALITY,
    "price_text_parse": PRICE_TEXT_PARSE,
    "price_text_negotiable": PRICE_TEXT_NEGOTIABLE,
    "city_dictionary_lookup": CITY_DICTIONARY_LOOKUP,
    "city_dictionary_lookup_large": CITY_DICTIONARY_LOOKUP_LARGE,
    "city_positional": CITY_POSITIONAL,
    "rooms_first_char": ROOMS_FIRST_CHAR,
    "area_prefix": AREA_PREFIX,
    "area_round_half_even": AREA_ROUND_HALF_EVEN,
    "page_items": PAGE_ITEMS,
    "page_items_skip_promoted": PAGE_ITEMS_SKIP_PROMOTED,
    "page_title": PAGE_TITLE,
    "union_sources": UNION_SOURCES,
    "missing_pages": MISSING_PAGES,
    "page_catalogue": PAGE_CATALOGUE,
    "city_dictionary": CITY_DICTIONARY,
    "jdbc_round_trip": JDBC_ROUND_TRIP,
    "jdbc_city_summary": CITY_SUMMARY,
    "snapshot_rewrite": SNAPSHOT_REWRITE,
    "snapshot_city_summary": CITY_SUMMARY,
    "stored_city_summary": CITY_SUMMARY,
    "stored_main_city_summary": MAIN_CITY_SUMMARY,
}


# ---- full ingest of rendered portal pages (portal_pages.py) --------------------------------------------
_PORTAL_BASE = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus, o_orderpriority, c_acctbal, n_name,
    CASE WHEN l_returnflag = 'R' THEN 'portal_b' ELSE 'portal_a' END AS source, """ + TYPE_OF_STATUS + """ AS type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

PORTAL_INGEST = """WITH base AS (""" + _PORTAL_BASE + """),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, type ORDER BY l_orderkey, l_linenumber, l_extendedprice,
  l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM base),
kept AS (SELECT * FROM ranked WHERE source = 'portal_b' OR rn > 3),
listing AS (SELECT
  'Mieszkanie ' || o_orderpriority || ' & ogród' ||
    CASE o_orderpriority WHEN '1-URGENT' THEN ' pilne!' WHEN '2-HIGH' THEN ' sprzedam pilnie' ELSE '' END AS post_title,
  CASE WHEN source = 'portal_a'
       THEN CASE WHEN l_discount = 0 OR l_tax = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(""" + _WHOLE + """ AS DOUBLE) END
       ELSE CASE WHEN l_discount = 0 THEN CAST(NULL AS DOUBLE) ELSE round(CAST(""" + _CENTS + """ AS DOUBLE) / 100, 2) END
  END AS post_price,
  CASE WHEN source = 'portal_a' AND c_acctbal < 0 THEN CAST(NULL AS VARCHAR) ELSE n_name END AS post_city,
  CASE WHEN source = 'portal_a'
       THEN CASE WHEN least(l_linenumber, 5) IN (3, 4)
                 THEN CASE WHEN l_returnflag = 'A' THEN CAST(NULL AS DOUBLE) ELSE l_quantity * 2.5 END
                 ELSE CAST(0 AS DOUBLE) END
       ELSE CASE WHEN type = 'room' OR l_linenumber = 7 THEN CAST(NULL AS DOUBLE)
                 ELSE CAST(round_even(l_quantity / 2, 0) AS DOUBLE) END
  END AS post_sqmetrage,
  CASE WHEN source = 'portal_a'
       THEN CASE WHEN least(l_linenumber, 5) IN (3, 4)
                 THEN CAST(left(CAST(CAST(floor(l_quantity / 4) AS BIGINT) AS VARCHAR), 1) AS INTEGER) ELSE 0 END
  END AS post_rooms,
  """ + D + """ AS download_date, type, source
  FROM kept)
SELECT *,
  CASE WHEN source = 'portal_b' AND type = 'room' THEN '0'
       WHEN post_sqmetrage < 30 THEN '<30'
       WHEN post_sqmetrage >= 30 AND post_sqmetrage < 50 THEN '30-49'
       WHEN post_sqmetrage >= 50 AND post_sqmetrage < 75 THEN '50-74'
       WHEN post_sqmetrage >= 75 AND post_sqmetrage <= 100 THEN '75-100'
       ELSE '>100' END AS sqm_bucket,
  CASE WHEN contains(post_title, 'pilne') OR contains(post_title, 'pilnie') THEN 'urgent' ELSE 'normal' END AS urgency,
  CASE WHEN source = 'portal_b' AND type = 'room' THEN CAST(0 AS DOUBLE)
       ELSE post_price / NULLIF(post_sqmetrage, 0) END AS price_per_sqm
FROM listing"""

PORTAL_INGEST_SUMMARY = ("SELECT post_city, type, " + AGGS + ", " + D + " AS download_date FROM (" + PORTAL_INGEST +
                         ") e GROUP BY post_city, type")

ORACLES["portal_ingest"] = PORTAL_INGEST
ORACLES["portal_ingest_summary"] = PORTAL_INGEST_SUMMARY
ORACLES["landed_pages"] = """SELECT DISTINCT source, type, l_orderkey AS page,
  'https://listings.example/' || source || '/' || type || '?page=' || CAST(l_orderkey AS VARCHAR) AS url,
  '<!DOCTYPE html>' AS doctype FROM (""" + _PORTAL_BASE + """) b"""
ORACLES["price_text_faults"] = """SELECT l_returnflag,
  CASE WHEN l_linenumber = 7 THEN 'missing' WHEN l_discount = 0 THEN 'ask' WHEN l_tax = 0 THEN 'unparseable' ELSE 'ok' END AS status,
  count(*) AS number_of_posts FROM lineitem GROUP BY 1, 2"""

_EDGE = "(l_orderkey + l_linenumber) % 8"
_QTY = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
ORACLES["page_edges"] = f"""SELECT l_orderkey, l_linenumber, pos,
  CASE WHEN pos = 1 THEN 'Inner ' WHEN {_EDGE} = 7 THEN 'Lot 5 < 6 ' || chr(169) ELSE 'Lot ' END || CAST(l_orderkey AS VARCHAR) AS title,
  CASE WHEN pos = 1 THEN '1' || {_QTY} || ' zł' WHEN {_EDGE} = 1 THEN '1' || {_QTY} || ' zł|' || {_QTY} || ' zł'
       WHEN {_EDGE} = 7 THEN {_QTY} || chr(160) || 'zł' ELSE {_QTY} || ' zł' END AS spans,
  CAST(CASE WHEN {_EDGE} = 1 THEN '1' ELSE '' END || {_QTY} AS DOUBLE) AS price
FROM lineitem, (SELECT 0 AS pos UNION ALL SELECT 1) p WHERE pos = 0 OR {_EDGE} = 1"""
_KEY = "CAST(l_orderkey AS VARCHAR)"
ORACLES["entity_text"] = f"""SELECT l_orderkey, l_linenumber, CASE {_EDGE}
  WHEN 0 THEN chr(169) || {_KEY} WHEN 1 THEN chr(172) || 'it;' || {_KEY} WHEN 2 THEN chr(189) || {_KEY}
  WHEN 3 THEN {_KEY} || chr(160) || 'zł' WHEN 4 THEN chr(CAST(l_linenumber AS INTEGER) + 64) || {_KEY}
  WHEN 5 THEN '&lt;' || {_KEY} || '<x' WHEN 6 THEN chr(8770) || chr(824) || '&nosuch;&' || {_KEY}
  ELSE chr(193) || 'x=' || chr(243) || '=' || {_KEY} END AS decoded FROM lineitem"""

_EXACT = ", ".join(
    f"round(CAST(sum(CAST({c} AS DECIMAL(28, 10))) AS DOUBLE) / count({c}), 0) AS {a}" + "".join(
        f", {f}({c}) AS {f}_{b}" for f in ("min", "max") if b)
    for c, a, b in (("post_price", "avg_price", "price"), ("post_rooms", "avg_rooms", ""),
                    ("post_sqmetrage", "avg_sqmetrage", "sqmetrage"), ("price_per_sqm", "avg_price_sqm", "price_sqm")))
ORACLES["city_summary_merged"] = f"""SELECT post_city, type, {_EXACT}, count(*) AS number_of_posts, download_date
FROM ({ENR}) e GROUP BY post_city, type, download_date"""
ORACLES["city_summary_all_time"] = f"""SELECT post_city, type, {_EXACT}, count(*) AS number_of_posts
FROM ({ENR}) e GROUP BY post_city, type"""

ORACLES["landed_page_bodies"] = """SELECT 'web' AS source, page_id AS page, url, length(html) AS html_chars, md5(html) AS html_md5 FROM pages"""
ORACLES["html_files"] = """SELECT page_id AS page, length(t) AS html_chars, md5(t) AS html_md5 FROM (SELECT page_id,
  CASE WHEN page_id % 4 = 1 THEN '<meta charset=''iso-8859-2''>' ELSE '' END || 'Zażółć ' ||
  regexp_replace(html, '[^\\x00-\\x7F]', 'ł', 'g') AS t FROM pages) p"""

_FAULTS = (("price_unreadable", "CASE WHEN source = 'portal_a' THEN l_discount <> 0 AND l_tax = 0 ELSE l_discount = 0 END"),
           ("city_unknown", "source = 'portal_a' AND c_acctbal < 0"),
           ("area_missing", "source = 'portal_b' AND type <> 'room' AND l_linenumber = 7"),
           ("area_unreadable", "source = 'portal_a' AND least(l_linenumber, 5) IN (3, 4) AND l_returnflag = 'A'"))
ORACLES["quarantine_reasons"] = "WITH base AS (" + _PORTAL_BASE + """), ranked AS (SELECT *, row_number() OVER (PARTITION BY source, type
  ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM base),
kept AS (SELECT * FROM ranked WHERE source = 'portal_b' OR rn > 3)
""" + " UNION ALL ".join(f"SELECT source, type, '{name}' AS fault, count(*) AS number_of_posts FROM kept WHERE {cond} GROUP BY source, type"
                         for name, cond in _FAULTS)

ORACLES["nfkd_text"] = """SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || ' fi e' || chr(808) || ' A' || chr(778) || ' '
  || chr(4352) || chr(4449) || CAST(l_linenumber AS VARCHAR) AS normal FROM lineitem"""
