"""Link graph: links, edges, crawl reachability, status and byte accounting.

The crawl is a breadth-first fixpoint run as a driver loop of DataFrame
rounds (Spark 4.1 recursive CTEs only allow UNION ALL, which does not stop on
cycles).  The fetch status of every link target is attached to the links
once; the links are written as a table bucketed on their source, the URLs seen
so far as one table bucketed on their path, to which each round appends its
own.  A round is one job whatever the depth: the frontier meets the links in
place (broadcast where its observed bytes prove it small, which opens only the
buckets of its own pages, else shuffled: it, not the links), and its distinct targets meet the seen table in one anti-join,
in place too.  Only candidates move; a lost executor recomputes one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import text as T
from ..functions.arrays import explode_rows
from ..functions.urls import href_targets, normalize_url, site_of
from ..session import append_bucketed, bucketed_table, scratch_path
from .prefix import running_sums

from ..fixed import IN_PROGRESS_REPLY as IN_PROGRESS
from ..fixed import STATUS_FORBIDDEN, STATUS_MISSING, STATUS_OK

READY = "ready"


def extract_links(pages: DataFrame) -> DataFrame:
    """``(src, raw_dst, dst)``: every anchor target of every page, in page
    order; ``dst`` has one leading ``../`` stripped (the queue key)."""
    return (explode_rows(pages, [F.col("path").alias("src")], href_targets("html"), "raw_dst")
            .select("src", "raw_dst", normalize_url("raw_dst", 1).alias("dst")))


def edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)``: distinct links."""
    return extract_links(pages).select("src", "dst").distinct()


def fetch_path(key) -> "F.Column":
    """Page looked up for a queue key: the crawler and then the server each
    strip one more leading ``../``."""
    return normalize_url(key, 2)


def page_index(pages: DataFrame) -> DataFrame:
    """``(path, readable, n_bytes)``: what a status lookup needs (no text)."""
    return pages.select("path", F.col("readable").cast("boolean").alias("readable"), T.text_bytes("html").alias("n_bytes"))


def _status(found_path, readable) -> "F.Column":
    return (F.when(found_path.isNull(), F.lit(STATUS_MISSING))
            .when(~readable, F.lit(STATUS_FORBIDDEN)).otherwise(F.lit(STATUS_OK)).cast("int"))


def _bytes(found_path, readable, n_bytes) -> "F.Column":
    return F.when(found_path.isNotNull() & readable, n_bytes).otherwise(F.lit(0)).cast("bigint")


def with_status(keys: DataFrame, pidx: DataFrame) -> DataFrame:
    """``keys(path, depth)`` -> ``(path, depth, fetch, status, bytes)``."""
    p = pidx.select(F.col("path").alias("fetch"), F.col("path").alias("found"), "readable", "n_bytes")
    j = keys.withColumn("fetch", fetch_path("path")).join(p, "fetch", "left")
    return j.select("path", "depth", "fetch", _status(F.col("found"), F.col("readable")).alias("status"),
                    _bytes(F.col("found"), F.col("readable"), F.col("n_bytes")).alias("bytes"))


def edge_status(link_edges: DataFrame, pidx: DataFrame) -> DataFrame:
    """``(src, path, fetch, status, bytes)``: every link with the status a
    fetch of its target gets.  One join before the crawl, so the rounds do
    no page lookups.  A target linked from a third of all pages is a skewed
    key of this join: AQE's skew split divides the link side."""
    e = link_edges.select("src", F.col("dst").alias("path"), fetch_path("dst").alias("fetch"))
    p = pidx.select(F.col("path").alias("fetch"), F.col("path").alias("found"), "readable", "n_bytes")
    j = e.join(p, "fetch", "left")
    return j.select("src", "path", "fetch", _status(F.col("found"), F.col("readable")).alias("status"),
                    _bytes(F.col("found"), F.col("readable"), F.col("n_bytes")).alias("bytes"))


# Partition column of the stored links: the bucket of ``src``.
LINK_PART = "src_part"


def frontier_step(frontier: DataFrame, linked: DataFrame, seen: DataFrame, small: bool = False, parts: int = 0) -> DataFrame:
    """One crawl round: targets of links of the frontier's readable pages
    (``status`` 200, looked up at ``fetch``) whose key was never seen.
    ``linked`` is :func:`edge_status`, ``seen`` a frame with ``path``;
    ``-> (path, fetch, status, bytes)``.

    ``small`` says that the frontier is proven small: it is broadcast.  With
    ``linked`` bucketed on ``src`` and ``seen`` on ``path``, both are read in
    place: the frontier (if large) and the distinct targets are shuffled, once
    each, and there is one anti-join however many rounds came before.  Where
    ``linked`` has the partition column ``LINK_PART`` (its bucket, one of
    ``parts``), a broadcast frontier prunes it at run time: a round opens the
    buckets of its own pages alone."""
    srcs = frontier.where(F.col("status") == STATUS_OK).select(F.col("fetch").alias("src"))
    on = ["src"]
    if small:
        if parts:
            srcs, on = srcs.withColumn(LINK_PART, session.bucket_of("src", parts)), ["src", LINK_PART]
        srcs = F.broadcast(srcs)
    cand = linked.join(srcs, on, "left_semi").select("path", "fetch", "status", "bytes").dropDuplicates(["path"])
    return cand.join(seen.select("path"), "path", "left_anti")


# Tuning: rounds after which the seen table's small files are written anew.
COMPACT_ROUNDS = 8


def crawl(pages: DataFrame, start: str, max_depth: int | None = None) -> DataFrame:
    """``(path, depth, status, bytes)``: every URL the crawl discovers from
    ``start`` with its breadth-first depth, the status a fetch gets and the
    body bytes (200 only).  Links are followed from readable pages only.

    ``max_depth`` stops fetching after that depth: what was discovered but not
    fetched is returned too, one deeper, with NULL status and bytes."""
    spark: SparkSession = pages.sparkSession
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pidx = page_index(pages)
    cols = ["path", "depth", "fetch", "status", "bytes"]
    links, link_table, _ = bucketed_table(edge_status(edges(pages.where(F.col("readable"))), pidx), "src", n_buckets, "crawl-links", partition=LINK_PART)
    tables = [link_table]
    try:
        first = with_status(spark.createDataFrame([(start, 0)], "path string, depth bigint"), pidx).select(*cols)
        folder = scratch_path(spark, "crawl-seen")
        _, seen, added = bucketed_table(first, "path", n_buckets, "crawl-seen", folder)
        tables.append(seen)
        depth = 0
        while added:
            every = spark.table(seen)
            frontier = every.where(F.col("depth") == depth)
            new = frontier_step(frontier, links, every, added <= session.BROADCAST_BYTE_LIMIT, n_buckets)
            depth += 1
            last = max_depth is not None and depth > max_depth
            if last:
                new = new.withColumn("status", F.lit(None).cast("int")).withColumn("bytes", F.lit(None).cast("bigint"))
            added = append_bucketed(new.withColumn("depth", F.lit(depth).cast("bigint")).select(*cols), seen, "path", n_buckets, folder)
            if last:
                break
            if depth % COMPACT_ROUNDS == 0:
                folder = scratch_path(spark, "crawl-seen")
                _, seen, _ = bucketed_table(spark.table(seen), "path", n_buckets, "crawl-seen", folder)
                tables.append(seen)
        return spark.read.schema(first.schema).parquet(folder).select("path", "depth", "status", "bytes")
    finally:
        for t in tables:  # external tables: the folders stay, the catalog entries go
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def seen_urls(link_edges: DataFrame, start: str) -> DataFrame:
    """``(url)``: distinct link targets plus the start page."""
    spark = link_edges.sparkSession
    return (link_edges.select(F.col("dst").alias("url"))
            .unionByName(spark.createDataFrame([(start,)], "url string")).distinct())


def dangling_links(link_edges: DataFrame, pages: DataFrame) -> DataFrame:
    """``(src, dst)``: links whose target page does not exist (a fetch would
    answer 404)."""
    return (link_edges.withColumn("fetch", fetch_path("dst"))
            .join(pages.select(F.col("path").alias("fetch")), "fetch", "left_anti").select("src", "dst"))


def in_degree(link_edges: DataFrame, pages: DataFrame) -> DataFrame:
    """``(path, in_degree)`` of every page (distinct linking pages)."""
    inc = (link_edges.select(F.col("src"), fetch_path("dst").alias("path")).distinct()
           .groupBy("path").agg(F.count(F.lit(1)).alias("in_degree")))
    return (pages.select("path").join(inc, "path", "left")
            .select("path", F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree")))


def inlink_audit(link_edges: DataFrame, pages: DataFrame) -> DataFrame:
    """``(path, site)``: pages that no link points to."""
    # distinct first: a page linked from a third of all pages collapses to one
    # row per task (map-side) before the anti-join's shuffle
    targets = link_edges.select(fetch_path("dst").alias("path")).distinct()
    return pages.select("path").join(targets, "path", "left_anti").select("path", site_of("path").alias("site"))


def inlink_coverage(link_edges: DataFrame, pages: DataFrame) -> DataFrame:
    """One row ``(n_pages, n_unlinked, all_linked)``: the generator's
    self-check, done right (does every page have an incoming link?)."""
    deg = in_degree(link_edges, pages)
    return deg.agg(F.count(F.lit(1)).alias("n_pages"),
                   F.count(F.when(F.col("in_degree") == 0, True)).alias("n_unlinked")).select(
        "n_pages", "n_unlinked", (F.col("n_unlinked") == 0).alias("all_linked"))


def unreached_pages(pages: DataFrame, crawled: DataFrame) -> DataFrame:
    """``(path)``: pages that exist but the crawl never requests."""
    asked = crawled.select(fetch_path("path").alias("path")).distinct()
    return pages.select("path").join(asked, "path", "left_anti")


def crawl_stats(crawled: DataFrame) -> DataFrame:
    """``(status, n_urls, downloads, bytes)``: a download counts when it
    returned more than zero bytes."""
    return (crawled.groupBy("status")
            .agg(F.count(F.lit(1)).alias("n_urls"),
                 F.count(F.when(F.col("bytes") > 0, True)).alias("downloads"),
                 F.sum(F.when(F.col("bytes") > 0, F.col("bytes")).otherwise(F.lit(0))).cast("bigint").alias("bytes")))


def crawl_pending(crawled: DataFrame) -> DataFrame:
    """``(max_depth, fetched, pending, gate)``: for each round limit, the URLs
    fetched and the URLs discovered but not fetched, and the reply a SEARCH
    would get.  Rows without a status wait in the queue: their depth is no
    limit reached.  Grouped by depth first: one row per depth reaches the window."""
    from pyspark.sql import Window as W

    per = crawled.groupBy("depth").agg(F.count(F.lit(1)).alias("n"), F.count("status").alias("done"))
    w = W.orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    nxt = W.orderBy("depth")
    return (per.select(F.col("depth").alias("max_depth"), F.sum("done").over(w).cast("bigint").alias("fetched"),
                       F.coalesce(F.lead("n").over(nxt), F.lit(0)).cast("bigint").alias("pending"), "done")
            .where("done > 0").drop("done").withColumn("gate", _gate("pending")))


def _gate(pending: str) -> "F.Column":
    return F.when(F.col(pending) > 0, F.lit(IN_PROGRESS)).otherwise(F.lit(READY))


def crawl_gate(crawled: DataFrame) -> DataFrame:
    """One row ``(fetched, pending, gate)``: what a crawl has fetched, what
    still waits, and the reply that a SEARCH gets now."""
    return (crawled.agg(F.count("status").alias("fetched"), (F.count(F.lit(1)) - F.count("status")).alias("pending"))
            .withColumn("gate", _gate("pending")))


def crawl_log(crawled: DataFrame, start: int, seconds: int) -> DataFrame:
    """``(path, ts, fetched, downloads, bytes, pending)``: the crawl's counters
    after each fetch.  URLs are fetched by depth, then path, one each
    ``seconds`` from the second ``start`` on; ``pending`` counts the URLs
    that the crawl still fetches after it.  Running sums are chunked, so the
    log of a crawl of any size is made by all tasks."""
    done = crawled.where(F.col("status").isNotNull()).select("path", "depth", F.col("bytes").alias("size"))
    got = F.col("size") > 0
    run = running_sums(done, keys=[], order=["depth", "path"],
                       values={"fetched": F.lit(1).cast("bigint"), "downloads": F.when(got, 1).otherwise(0).cast("bigint"),
                               "bytes": F.when(got, F.col("size")).otherwise(0).cast("bigint")})
    total = run.agg(F.count(F.lit(1))).first()[0]
    return run.select("path", F.timestamp_seconds(F.lit(start) + F.col("fetched") * seconds).alias("ts"), "fetched", "downloads", "bytes",
                      (F.lit(total) - F.col("fetched")).cast("bigint").alias("pending"))


def fetched_pages(pages: DataFrame, crawled: DataFrame) -> DataFrame:
    """The pages a crawl saves: fetched with status 200 and not empty."""
    saved = crawled.where((F.col("status") == STATUS_OK) & (F.col("bytes") > 0)).select(fetch_path("path").alias("path")).distinct()
    return pages.join(saved, "path", "left_semi")
