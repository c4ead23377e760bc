"""Page, request, query and command tables derived from the driver tables.

The reference reads a directory of generated HTML sites.  Here the same shape
is derived deterministically from ``documents`` and ``events``: 20 sites, the
generator's header lines, a tab-led body line, anchors to other pages and the
literal tail.  Everything is per-row expressions over the scanned table (no
join, no shuffle); the only global value is the page count per site, taken
from one parquet ``count()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table, spread

N_SITES = 20
START_PAGE = "site0/page0_1000.html"
FETCH_SECONDS = 600  # the crawl's log: one URL each ten minutes from the first event on


def _s(c: Column) -> Column:
    return c.cast("string")


def page_name(site: Column, number: Column) -> Column:
    """``site{s}/page{s}_{n}.html`` (the generator's naming)."""
    return F.concat(F.lit("site"), _s(site), F.lit("/page"), _s(site), F.lit("_"), _s(number), F.lit(".html"))


def anchor(target: Column, label: str) -> Column:
    """One generated link line, with the generator's ``../`` prefix."""
    return F.concat(F.lit('<a href="../'), target, F.lit(f'"> {label}</a> \n'))


def pages_per_site(documents: DataFrame) -> int:
    """Pages per site: the document count (from the parquet footers) over the
    number of sites."""
    m = documents.count() // N_SITES
    if m < 1:
        raise ValueError(f"need at least {N_SITES} documents for the page fixture")
    return m


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``corpus(doc_id, path, readable, html)``: one row per page."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    m = pages_per_site(docs)
    return corpus_rows(spread(docs, "doc_id"), m)


def corpus_rows(docs: DataFrame, m: int) -> DataFrame:
    """Per-row page builder (also used on a stream of documents)."""
    s = F.col("doc_id") % N_SITES
    i = F.floor(F.col("doc_id") / N_SITES).cast("bigint")
    i0 = (2 * i + 1) % m
    i1 = (2 * i + 2) % m
    s2 = (3 * s + 1) % N_SITES
    html = F.concat(
        F.lit("<!DOCTYPE html>\n<html> \n\t <body>\n"),
        anchor(page_name(s, 1000 + i0), "link0"),
        F.col("text"), F.lit("\n"),
        F.when(F.col("doc_id") % 5 != 0, anchor(page_name(s, 1000 + i1), "link1")).otherwise(F.lit("")),
        F.when(i % 3 == 0, anchor(page_name(s2, 1000 + i), "link2")).otherwise(F.lit("")),
        F.when(F.col("doc_id") % 7 == 0, anchor(page_name(s, 900000 + i), "link3")).otherwise(F.lit("")),
        F.lit("\\t</body>\\n</html>\n"),
    )
    return docs.select(
        "doc_id",
        page_name(s, 1000 + i).alias("path"),
        (F.col("doc_id") % 11 != 5).alias("readable"),
        html.alias("html"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests(event_id, ts, server, is_cmd, path, raw)``.

    ``signup`` events are STATS commands, the rest page requests; page numbers
    run past the last page so some requests are 404, and every 13th request
    says ``GET`` which the request parser rejects.
    """
    m = pages_per_site(read_table(spark, sf_dir, "documents").select("doc_id"))
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return requests_rows(ev, m)


def requests_rows(ev: DataFrame, m: int) -> DataFrame:
    """Per-row request builder (also used on a stream of events)."""
    site = F.col("event_id") % N_SITES
    num = 1000 + F.floor(F.col("event_id") / N_SITES).cast("bigint") % (m + 10)
    path = page_name(site, num)
    verb = F.when(F.col("event_id") % 13 == 0, F.lit("GET")).otherwise(F.lit("Get"))
    return ev.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") % 4).alias("server"),
        (F.col("event_type") == "signup").alias("is_cmd"),
        path.alias("path"),
        F.concat(verb, F.lit(" ../"), path, F.lit(" HTTP/1.1\r\n\r\n")).alias("raw"),
    )


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``search_queries(query_id, raw)``: every word of each benchmark text as
    a SEARCH command (with a doubled space)."""
    b = read_table(spark, sf_dir, "benchmark")
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    return b.select(F.col("item_id").alias("query_id"), F.concat(F.lit("SEARCH  "), flat, F.lit("\r\n")).alias("raw"))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``commands(event_id, ts, raw)``: a command stream over ``events``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return commands_from_events(ev)


def first_second(spark: SparkSession, sf_dir: str) -> int:
    """Second of the first event: the crawler's start."""
    ts = F.col("ts").cast("timestamp")
    return read_table(spark, sf_dir, "events").agg(F.min(F.unix_seconds(ts))).first()[0]


def commands_from_events(ev: DataFrame) -> DataFrame:
    t = F.col("event_type")
    raw = (F.when(t == "signup", F.lit("STATS\r\n"))
           .when(t == "error", F.lit("SHUTDOWN\r\n"))
           .when(t == "view", F.lit("SEARCH\r\n"))
           .when(t == "purchase", F.lit("stats\r\n"))
           .otherwise(F.concat(F.lit("SEARCH the  of "), t, F.lit("\r\n"))))
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), raw.alias("raw"))


# Fixed SQL text of the same four fixtures, for DuckDB oracles (one CTE each).
CORPUS_SQL = r"""corpus AS (
WITH n AS (SELECT CAST(floor(count(*) / 20) AS BIGINT) AS m FROM documents),
b AS (SELECT doc_id, text, doc_id % 20 AS s, CAST(floor(doc_id / 20) AS BIGINT) AS i, m FROM documents CROSS JOIN n),
t AS (SELECT b.*, (2 * i + 1) % m AS i0, (2 * i + 2) % m AS i1, (3 * s + 1) % 20 AS s2 FROM b)
SELECT doc_id,
  'site' || s || '/page' || s || '_' || (1000 + i) || '.html' AS path,
  doc_id % 11 <> 5 AS readable,
  '<!DOCTYPE html>' || chr(10) || '<html> ' || chr(10) || chr(9) || ' <body>' || chr(10)
  || '<a href="../site' || s || '/page' || s || '_' || (1000 + i0) || '.html"> link0</a> ' || chr(10)
  || text || chr(10)
  || CASE WHEN doc_id % 5 <> 0 THEN '<a href="../site' || s || '/page' || s || '_' || (1000 + i1) || '.html"> link1</a> ' || chr(10) ELSE '' END
  || CASE WHEN i % 3 = 0 THEN '<a href="../site' || s2 || '/page' || s2 || '_' || (1000 + i) || '.html"> link2</a> ' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 7 = 0 THEN '<a href="../site' || s || '/page' || s || '_' || (900000 + i) || '.html"> link3</a> ' || chr(10) ELSE '' END
  || chr(92) || 't</body>' || chr(92) || 'n</html>' || chr(10) AS html
FROM t)"""

REQUESTS_SQL = r"""requests AS (
SELECT event_id, ts, user_id % 4 AS server, event_type = 'signup' AS is_cmd,
  'site' || (event_id % 20) || '/page' || (event_id % 20) || '_' || (1000 + CAST(floor(event_id / 20) AS BIGINT) % (m + 10)) || '.html' AS path,
  CASE WHEN event_id % 13 = 0 THEN 'GET' ELSE 'Get' END || ' ../site' || (event_id % 20) || '/page' || (event_id % 20) || '_'
  || (1000 + CAST(floor(event_id / 20) AS BIGINT) % (m + 10)) || '.html HTTP/1.1' || chr(13) || chr(10) || chr(13) || chr(10) AS raw
FROM events CROSS JOIN (SELECT CAST(floor(count(*) / 20) AS BIGINT) AS m FROM documents) AS n)"""

SEARCH_QUERIES_SQL = r"""search_queries AS (
SELECT item_id AS query_id, 'SEARCH  ' || replace(text, chr(10), ' ') || chr(13) || chr(10) AS raw
FROM benchmark)"""

COMMANDS_SQL = r"""commands AS (
SELECT event_id, ts,
  CASE event_type WHEN 'signup' THEN 'STATS' || chr(13) || chr(10)
    WHEN 'error' THEN 'SHUTDOWN' || chr(13) || chr(10)
    WHEN 'view' THEN 'SEARCH' || chr(13) || chr(10)
    WHEN 'purchase' THEN 'stats' || chr(13) || chr(10)
    ELSE 'SEARCH the  of ' || event_type || chr(13) || chr(10) END AS raw
FROM events)"""
