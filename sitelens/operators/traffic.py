"""Request and command logs: parsing, status, counters, running statistics.

The server's and the crawler's process-lifetime counters become aggregates
over a request table (or stream); the STATS reply becomes the running
aggregate as of each command row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import uptime_hms
from ..functions.urls import normalize_url
from .asof import asof_join
from .graph import IN_PROGRESS, READY, STATUS_FORBIDDEN, STATUS_MISSING, STATUS_OK, page_index
from .prefix import running_sums
from .search import command_words

from ..fixed import (CRAWLER_STATS_FORMAT, REQUEST_VERB, SEARCH_VERB, SERVER_STATS_FORMAT, SERVER_UNKNOWN_REPLY, SHUTDOWN_COMMAND,
                     STATS_COMMAND, UNKNOWN_REPLY)

# the first space-separated word is the verb (leading spaces skipped)
SEARCH_VERB_PATTERN = rf"^ *{SEARCH_VERB}( |\z)"
REQUEST_PATTERN = rf"^ *{REQUEST_VERB} +([^ ]+)"


def request_log(requests: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``req_path``: the word after a first word exactly ``Get``, with
    one leading ``../`` stripped (the server's strip); NULL otherwise."""
    r = F.col(raw)
    path = F.when(r.rlike(rf"^ *{REQUEST_VERB} +[^ ]"), normalize_url(F.regexp_extract(r, REQUEST_PATTERN, 1), 1))
    return requests.withColumn("req_path", path)


def command_kind(raw) -> Column:
    r = F.col(raw) if isinstance(raw, str) else raw
    return (F.when(r == STATS_COMMAND, F.lit("STATS"))
            .when(r == SHUTDOWN_COMMAND, F.lit("SHUTDOWN"))
            .when(r.rlike(SEARCH_VERB_PATTERN), F.lit("SEARCH"))
            .otherwise(F.lit("UNKNOWN")))


def command_log(cmds: DataFrame, raw: str = "raw", max_terms: int | None = None) -> DataFrame:
    """Adds ``kind`` (STATS, SHUTDOWN, SEARCH, UNKNOWN; case-sensitive),
    ``terms`` (SEARCH words, order and repeats kept) and ``reply`` (the
    refusal text for UNKNOWN)."""
    kind = command_kind(raw)
    words = command_words(raw)
    terms = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    if max_terms is not None:
        terms = F.slice(terms, 1, max_terms)
    return (cmds.withColumn("kind", kind)
            .withColumn("terms", F.when(F.col("kind") == "SEARCH", terms))
            .withColumn("reply", F.when(F.col("kind") == "UNKNOWN", F.lit(UNKNOWN_REPLY))))


def server_command_log(cmds: DataFrame, raw: str = "raw") -> DataFrame:
    """The server's command set: adds ``kind`` (STATS, SHUTDOWN, UNKNOWN: a
    SEARCH is unknown to it) and ``reply`` (its refusal text for UNKNOWN)."""
    kind = F.when(command_kind(raw) == "SEARCH", F.lit("UNKNOWN")).otherwise(command_kind(raw))
    return (cmds.withColumn("kind", kind)
            .withColumn("reply", F.when(F.col("kind") == "UNKNOWN", F.lit(SERVER_UNKNOWN_REPLY))))


def crawler_stats(crawled: DataFrame, secs: int = 0) -> DataFrame:
    """One row ``(uptime, downloads, bytes, reply)``: the crawler's STATS
    answer ``secs`` seconds after its start.  A download has more than zero bytes."""
    up = uptime_hms(F.lit(secs).cast("bigint"))
    got = crawled.agg(F.count(F.when(F.col("bytes") > 0, True)).cast("bigint").alias("downloads"),
                      F.coalesce(F.sum(F.when(F.col("bytes") > 0, F.col("bytes"))), F.lit(0)).cast("bigint").alias("bytes"))
    return got.select(up.alias("uptime"), "downloads", "bytes", F.format_string(CRAWLER_STATS_FORMAT, up, "downloads", "bytes").alias("reply"))


def crawler_asof(logged: DataFrame, log: DataFrame, start: int) -> DataFrame:
    """Classified commands with the crawl's ``downloads, bytes, pending`` as of
    their time, the ``gate`` that a SEARCH meets and their ``uptime``.

    ``log`` is :func:`.graph.crawl_log`.  Before its first row nothing is
    downloaded and the start page waits: a crawl that has not begun is in
    progress (``pending`` NULL)."""
    met = asof_join(logged, log.select("ts", "downloads", "bytes", "pending"), "ts", ["downloads", "bytes", "pending"])
    zero = F.lit(0).cast("bigint")
    ready = F.coalesce(F.col("pending") == 0, F.lit(False))
    return (met.withColumn("downloads", F.coalesce("downloads", zero)).withColumn("bytes", F.coalesce("bytes", zero))
            .withColumn("gate", F.when(ready, F.lit(READY)).otherwise(F.lit(IN_PROGRESS)))
            .withColumn("uptime", uptime_hms(whole_seconds("ts") - F.lit(start))))


def command_replies(asof: DataFrame) -> DataFrame:
    """``(event_id, kind, downloads, bytes, pending, reply)``: the reply that a
    command gets at its time, as far as no index is asked: the counters for
    STATS, the gate for a SEARCH while the crawl runs (else NULL), the refusal
    for UNKNOWN."""
    stats = F.format_string(CRAWLER_STATS_FORMAT, F.col("uptime"), F.col("downloads"), F.col("bytes"))
    waits = (F.col("kind") == "SEARCH") & (F.col("gate") != READY)
    reply = F.when(F.col("kind") == "STATS", stats).when(waits, F.col("gate")).otherwise(F.col("reply"))
    return asof.select("event_id", "kind", "downloads", "bytes", "pending", reply.alias("reply"))


def _with_status(reqs: DataFrame, pages: DataFrame | None, pidx: DataFrame | None = None) -> DataFrame:
    """Left join on the requested path.  A page requested by a third of all
    requests is a skewed join key: AQE's skew-join split handles it (the
    request side of a left outer join can be split).  ``pidx`` is a stored
    :func:`page_index` (used instead of ``pages`` when given)."""
    pidx = (pidx if pidx is not None else page_index(pages)).withColumnRenamed("path", "req_path")
    j = reqs.join(pidx, "req_path", "left")
    found = F.col("readable").isNotNull()
    status = (F.when(F.col("req_path").isNull(), F.lit(None))
              .when(~found, F.lit(STATUS_MISSING))
              .when(~F.col("readable"), F.lit(STATUS_FORBIDDEN))
              .otherwise(F.lit(STATUS_OK)).cast("int"))
    nbytes = F.when(found & F.col("readable"), F.col("n_bytes")).otherwise(F.lit(0)).cast("bigint")
    return j.withColumn("status", status).withColumn("bytes", F.when(F.col("req_path").isNotNull(), nbytes))


def request_status(requests: DataFrame, pages: DataFrame | None, pidx: DataFrame | None = None) -> DataFrame:
    """``(event_id, ts, server, path, status, bytes)`` for page requests: 404
    without a page, 403 for an unreadable one, else 200 with its bytes.
    Requests that do not parse (not ``Get``) have no path and are left out."""
    reqs = request_log(requests).where(~F.col("is_cmd") & F.col("req_path").isNotNull())
    return _with_status(reqs, pages, pidx).select("event_id", "ts", "server", F.col("req_path").alias("path"),
                                            "status", "bytes")


def served(status, nbytes) -> Column:
    """A response counts when it is a 200 with more than zero bytes."""
    return (F.col(status) == STATUS_OK) & (F.col(nbytes) > 0)


def server_stats(status: DataFrame) -> DataFrame:
    """``(server, served, bytes)`` over the request status table."""
    ok = served("status", "bytes")
    return (status.groupBy("server")
            .agg(F.count(F.when(ok, True)).cast("bigint").alias("served"),
                 F.sum(F.when(ok, F.col("bytes")).otherwise(F.lit(0))).cast("bigint").alias("bytes")))


def server_totals(requests: DataFrame, pages: DataFrame | None, pidx: DataFrame | None = None) -> DataFrame:
    """``(server, served, bytes)`` straight from a request log: requests are
    counted by server and page first (combined before the shuffle), so the
    page lookup sees one row for each, however often the page was asked for."""
    asked = (request_log(requests).where(~F.col("is_cmd") & F.col("req_path").isNotNull())
             .groupBy("server", "req_path").agg(F.count(F.lit(1)).alias("times")))
    ok = served("status", "bytes")
    return (_with_status(asked, pages, pidx).groupBy("server")
            .agg(F.coalesce(F.sum(F.when(ok, F.col("times"))), F.lit(0)).cast("bigint").alias("served"),
                 F.coalesce(F.sum(F.when(ok, F.col("times") * F.col("bytes"))), F.lit(0)).cast("bigint").alias("bytes")))


def whole_seconds(ts) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def stats_asof(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """``(event_id, server, served, bytes, uptime, reply)`` for every STATS
    command row: the server's counters over its earlier rows (by ts, then
    event_id) and its uptime since its first row, as ``HH:MM:SS``.

    Running sums are chunked (see :mod:`.prefix`), so a server with a third of
    all requests is spread over many tasks."""
    # only parsed page requests look their page up; commands and other rows go round the join
    logged = request_log(requests)
    is_request = ~F.col("is_cmd") & F.col("req_path").isNotNull()
    cols = ["event_id", "server", "is_cmd", whole_seconds("ts").alias("secs"), F.col("ts").cast("timestamp").alias("ts")]
    looked = _with_status(logged.where(is_request), pages).select(*cols, served("status", "bytes").alias("ok"), "bytes")
    other = logged.where(~is_request).select(*cols, F.lit(False).alias("ok"), F.lit(None).cast("bigint").alias("bytes"))
    rows = looked.unionByName(other)
    run = running_sums(
        rows, keys=["server"], order=["ts", "event_id"],
        values={"served": F.when(F.col("ok"), 1).otherwise(0).cast("bigint"),
                "bytes_run": F.when(F.col("ok"), F.col("bytes")).otherwise(0).cast("bigint")},
        keep=F.col("is_cmd"), firsts={"start_secs": "secs"})
    up = uptime_hms(F.col("secs") - F.col("start_secs"))
    return run.select("event_id", "server", F.col("served").cast("bigint").alias("served"),
                      F.col("bytes_run").cast("bigint").alias("bytes"), up.alias("uptime"),
                      F.format_string(SERVER_STATS_FORMAT, up, F.col("served"), F.col("bytes_run")).alias("reply"))
