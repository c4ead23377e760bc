"""Named queries: each key of SURVEY section 2 as ``f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or tables Spark derives from them)
whole; the page, request and command fixtures are derived per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NO_RESULTS
from ..functions import text as T
from ..functions.timefmt import uptime_hms
from ..functions.urls import normalize_url, site_of
from ..operators import graph as gr
from ..operators import index as ix
from ..operators import layout as lay
from ..operators import lines as ln
from ..operators import search as se
from ..operators import traffic as tr
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import index_store as ist
from ..sources import live_index as li
from ..sources import page_sets as ps
from ..sources import pages as pg
from ..sources import rank_store as rs
from ..sources import site_files as sf
from ..sources import term_store as ts
from ..sources.tables import index_parts, read_table, result_parts
from ..streaming import streams as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.corpus(spark, sf_dir)


@query("page_lines")
def q_page_lines(spark, sf_dir):
    return ln.page_lines(pages(spark, sf_dir))


@query("indexable_lines")
def q_indexable_lines(spark, sf_dir):
    return ln.indexable_lines(pages(spark, sf_dir))


@query("tokens")
def q_tokens(spark, sf_dir):
    return ln.tokens(pages(spark, sf_dir))


@query("occurrences")
def q_occurrences(spark, sf_dir):
    return ix.occurrences(pages(spark, sf_dir))


def flat_postings(post: DataFrame) -> DataFrame:
    """Postings with the offset list also as text (lists hash alike in any engine)."""
    return post.select("term", "path", "fr", F.array_join("offsets", "-").alias("offsets_text"),
                       F.size("offsets").cast("bigint").alias("n_offsets"))


@query("postings")
def q_postings(spark, sf_dir):
    return flat_postings(ix.postings(pages(spark, sf_dir)))


@query("lexicon")
def q_lexicon(spark, sf_dir):
    return ix.lexicon(ix.page_term_counts(pages(spark, sf_dir)))


# --- search -----------------------------------------------------------------

LOOKUP_WORD = "the"   # word looked up by the term_lookup query
TOP_K = 10            # ranking depth of rank_pages / rank_sites
CRAWL_SECONDS = 3986  # uptime shown in the crawler's STATS answer


def qterms(spark, sf_dir):
    return se.query_terms(fx.search_queries(spark, sf_dir))


@query("query_terms")
def q_query_terms(spark, sf_dir):
    return qterms(spark, sf_dir)


@query("query_word_filter")
def q_query_word_filter(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    lex = ix.lexicon(ix.page_term_counts(pages(spark, sf_dir), q.vocab))
    return se.query_word_filter(lex, q).select("query_id", "term", "df", "cf")


@query("term_lookup")
def q_term_lookup(spark, sf_dir):
    """One word looked up in the stored index (the filter reaches the scan)."""
    folder = scratch_path(spark, "index")
    ist.write_index(ix.occurrences(pages(spark, sf_dir)), folder, index_parts(spark, sf_dir))
    return flat_postings(ix.stored_postings(ist.lookup(spark, folder, LOOKUP_WORD)))


@query("search_hits")
def q_search_hits(spark, sf_dir):
    return se.search_hits(pages(spark, sf_dir), qterms(spark, sf_dir))


@query("search_rows")
def q_search_rows(spark, sf_dir):
    return se.search_rows(pages(spark, sf_dir), qterms(spark, sf_dir))


@query("search_rows_compat")
def q_search_rows_compat(spark, sf_dir):
    return se.search_rows(pages(spark, sf_dir), qterms(spark, sf_dir), compat=True)


@query("search_summary")
def q_search_summary(spark, sf_dir):
    return se.search_summary(pages(spark, sf_dir), qterms(spark, sf_dir))


@query("hit_ordinal")
def q_hit_ordinal(spark, sf_dir):
    return se.hit_ordinal(pages(spark, sf_dir), qterms(spark, sf_dir))


@query("search_ordered")
def q_search_ordered(spark, sf_dir):
    return se.search_ordered(se.search_hits(pages(spark, sf_dir), qterms(spark, sf_dir)))


@query("rank_pages")
def q_rank_pages(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    return se.rank_pages(ix.page_term_counts(pages(spark, sf_dir), q.vocab, se.TOTAL), q, k=TOP_K)


@query("rank_sites")
def q_rank_sites(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    return se.rank_sites(ix.page_term_counts(pages(spark, sf_dir), q.vocab), q, k=TOP_K)


@query("rank_stored")
def q_rank_stored(spark, sf_dir):
    """Store the index in blocks, then rank pages from it."""
    folder = scratch_path(spark, "rank-index")
    rs.write_rank_index(ix.page_term_counts(pages(spark, sf_dir), total=se.TOTAL), folder)
    return rs.rank_pages(spark, folder, qterms(spark, sf_dir), k=TOP_K)


@query("rank_sites_stored")
def q_rank_sites_stored(spark, sf_dir):
    folder = scratch_path(spark, "rank-index")
    rs.write_rank_index(ix.page_term_counts(pages(spark, sf_dir), total=se.TOTAL), folder)
    return rs.rank_sites(spark, folder, qterms(spark, sf_dir), k=TOP_K)


@query("union_rows")
def q_union_rows(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    u = se.union_rows(ix.postings(pages(spark, sf_dir), q.vocab), q)
    return u.select("query_id", "path", F.array_join("rows", "-").alias("rows_text"), "n_rows")


@query("sorted_vocabulary")
def q_sorted_vocabulary(spark, sf_dir):
    """The stored vocabulary in bytewise order, each word with its global rank."""
    folder = scratch_path(spark, "terms")
    ts.write_term_store(ix.postings(pages(spark, sf_dir)), folder)
    return ts.vocabulary(spark, folder).select("rank", "term", "df", "cf")


@query("search_terms")
def q_search_terms(spark, sf_dir):
    """The benchmark searches from the parts of the stored postings that hold their words."""
    folder = scratch_path(spark, "terms")
    ts.write_term_store(ix.postings(pages(spark, sf_dir)), folder)
    found = ts.search_terms(spark, folder, qterms(spark, sf_dir))
    return found.select("query_id", "path", F.array_join("rows", "-").alias("rows_text"), "n_rows", "freq")


def stored_page_sets(spark, sf_dir) -> str:
    folder = scratch_path(spark, "page-sets")
    ps.write_page_sets(pages(spark, sf_dir), folder, index_parts(spark, sf_dir))
    return folder


@query("search_page_sets")
def q_search_page_sets(spark, sf_dir):
    """The pages of every benchmark search, out of the union of its words' stored sets."""
    folder = stored_page_sets(spark, sf_dir)
    return ps.set_pages(spark, folder, ps.any_word(spark, folder, qterms(spark, sf_dir)))


@query("search_page_counts")
def q_search_page_counts(spark, sf_dir):
    """Pages that hold any, and every, word of a search, by popcount alone."""
    folder, q = stored_page_sets(spark, sf_dir), se.probe(qterms(spark, sf_dir))
    some = ps.page_counts(ps.any_word(spark, folder, q))
    every = ps.page_counts(ps.all_words(spark, folder, q)).withColumnRenamed("n_pages", "n_all")
    return some.join(every, "query_id", "left").select("query_id", "n_pages", F.coalesce("n_all", F.lit(0)).cast("bigint").alias("n_all"))


@query("search_report")
def q_search_report(spark, sf_dir):
    # a line is shown with each of its places in an answer: a third of the pages as many texts
    n = 3 * result_parts(spark, sf_dir)
    rows, answered = se.written_search(pages(spark, sf_dir), qterms(spark, sf_dir), n_parts=n)
    return se.search_report(rows, fx.search_queries(spark, sf_dir), answered)


@query("max_count")
def q_max_count(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    return ix.max_count(ix.page_term_counts(pages(spark, sf_dir), q.vocab), q.frame)


@query("min_count")
def q_min_count(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    return ix.min_count(ix.page_term_counts(pages(spark, sf_dir), q.vocab), q.frame)


# --- link graph -------------------------------------------------------------


@query("extract_links")
def q_extract_links(spark, sf_dir):
    return gr.extract_links(pages(spark, sf_dir))


@query("normalize_url")
def q_normalize_url(spark, sf_dir):
    return gr.extract_links(pages(spark, sf_dir)).select(
        "src", "raw_dst", normalize_url("raw_dst", 1).alias("once"), normalize_url("raw_dst", 2).alias("twice"))


@query("site_of")
def q_site_of(spark, sf_dir):
    p = pages(spark, sf_dir)
    urls = gr.edges(p).select(F.col("dst").alias("url")).unionByName(p.select(F.col("path").alias("url")))
    return urls.distinct().select("url", site_of("url").alias("site"))


@query("seen_urls")
def q_seen_urls(spark, sf_dir):
    return gr.seen_urls(gr.edges(pages(spark, sf_dir)), fx.START_PAGE)


@query("frontier_step")
def q_frontier_step(spark, sf_dir):
    p = pages(spark, sf_dir)
    start = spark.createDataFrame([(fx.START_PAGE, 0)], "path string, depth bigint")
    pidx = gr.page_index(p)
    frontier = gr.with_status(start, pidx)
    linked = gr.edge_status(gr.edges(p.where("readable")), pidx)
    return gr.frontier_step(frontier, linked, start, small=True).select("path")


@query("dangling_links")
def q_dangling_links(spark, sf_dir):
    p = pages(spark, sf_dir)
    return gr.dangling_links(gr.edges(p), p)


@query("inlink_audit")
def q_inlink_audit(spark, sf_dir):
    p = pages(spark, sf_dir)
    return gr.inlink_audit(gr.edges(p), p)


def crawled(spark, sf_dir):
    return gr.crawl(pages(spark, sf_dir), fx.START_PAGE)


@query("crawl")
def q_crawl(spark, sf_dir):
    return crawled(spark, sf_dir)


LIMIT_DEPTH = 2       # last depth that the limited crawl fetches


def limited(spark, sf_dir):
    return gr.crawl(pages(spark, sf_dir), fx.START_PAGE, max_depth=LIMIT_DEPTH)


@query("crawl_limited")
def q_crawl_limited(spark, sf_dir):
    """A crawl stopped at a depth: fetched URLs and those still in the queue."""
    return limited(spark, sf_dir)


@query("crawl_gate")
def q_crawl_gate(spark, sf_dir):
    """What a SEARCH is told while that crawl has URLs to fetch."""
    return gr.crawl_gate(limited(spark, sf_dir))


def saved_pages(spark, sf_dir):
    """Crawl, save what it fetched, read the store."""
    p = pages(spark, sf_dir)
    folder = scratch_path(spark, "crawled")
    pg.write_pages(gr.fetched_pages(p, gr.crawl(p, fx.START_PAGE)), folder)
    return pg.read_pages(spark, folder)


@query("crawled_rows")
def q_crawled_rows(spark, sf_dir):
    """Every benchmark search over the pages that the crawl saved."""
    return se.search_rows(saved_pages(spark, sf_dir), qterms(spark, sf_dir))


@query("crawled_rank")
def q_crawled_rank(spark, sf_dir):
    q = se.probe(qterms(spark, sf_dir))
    return se.rank_pages(ix.page_term_counts(saved_pages(spark, sf_dir), q.vocab, se.TOTAL), q, k=TOP_K)


@query("unreached_pages")
def q_unreached_pages(spark, sf_dir):
    return gr.unreached_pages(pages(spark, sf_dir), crawled(spark, sf_dir))


@query("crawl_stats")
def q_crawl_stats(spark, sf_dir):
    return gr.crawl_stats(crawled(spark, sf_dir))


@query("crawl_pending")
def q_crawl_pending(spark, sf_dir):
    return gr.crawl_pending(crawled(spark, sf_dir))


# --- requests, commands, counters ---------------------------------------------


@query("request_log")
def q_request_log(spark, sf_dir):
    return tr.request_log(fx.requests(spark, sf_dir)).select("event_id", "server", "is_cmd", "req_path")


@query("command_log")
def q_command_log(spark, sf_dir):
    c = tr.command_log(fx.commands(spark, sf_dir))
    return c.select("event_id", "kind", F.array_join("terms", " ").alias("terms_text"),
                    F.when(F.col("kind") == "SEARCH", F.size("terms")).cast("bigint").alias("n_terms"), "reply")


@query("request_status")
def q_request_status(spark, sf_dir):
    return tr.request_status(fx.requests(spark, sf_dir), pages(spark, sf_dir)).drop("ts")


@query("server_stats")
def q_server_stats(spark, sf_dir):
    return tr.server_totals(fx.requests(spark, sf_dir), pages(spark, sf_dir))


@query("crawler_stats")
def q_crawler_stats(spark, sf_dir):
    return tr.crawler_stats(crawled(spark, sf_dir), CRAWL_SECONDS)


def crawl_log(spark, sf_dir, start):
    return gr.crawl_log(crawled(spark, sf_dir), start, fx.FETCH_SECONDS)


@query("crawl_log")
def q_crawl_log(spark, sf_dir):
    return crawl_log(spark, sf_dir, fx.first_second(spark, sf_dir)).withColumn("ts", F.unix_seconds("ts"))


@query("command_replies")
def q_command_replies(spark, sf_dir):
    """Every command with the crawl's counters and gate as of its time."""
    start = fx.first_second(spark, sf_dir)
    return tr.command_replies(tr.crawler_asof(tr.command_log(fx.commands(spark, sf_dir)), crawl_log(spark, sf_dir, start), start))


@query("server_command_log")
def q_server_command_log(spark, sf_dir):
    return tr.server_command_log(fx.commands(spark, sf_dir)).select("event_id", "kind", "reply")


@query("stats_asof")
def q_stats_asof(spark, sf_dir):
    return tr.stats_asof(fx.requests(spark, sf_dir), pages(spark, sf_dir))


@query("uptime_hms")
def q_uptime_hms(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    secs = (F.unix_seconds("ts") - F.unix_seconds(F.date_trunc("month", "ts"))).cast("bigint")
    return ev.select("event_id", secs.alias("secs")).select("event_id", "secs", uptime_hms("secs").alias("uptime"))


# --- sources and sinks, text counts ---------------------------------------------


@query("scan_pages")
def q_scan_pages(spark, sf_dir):
    """Save every page as a file of its site's folder, then scan that folder."""
    root = scratch_path(spark, "site-files")
    sf.export_pages(pages(spark, sf_dir), root)
    return pg.scan_pages(spark, root)


@query("site_catalog")
def q_site_catalog(spark, sf_dir):
    return pg.site_catalog(pages(spark, sf_dir))


@query("write_pages")
def q_write_pages(spark, sf_dir):
    """Round trip: save every page, then some pages of one site again with
    another text; the store has the new texts beside all other pages."""
    folder = scratch_path(spark, "pages")
    p = pages(spark, sf_dir)
    pg.write_pages(p, folder)
    again = p.where(F.col("path").startswith("site3/") & (F.col("doc_id") % 3 == 0))
    pg.write_pages(again.withColumn("html", F.concat("html", F.lit("saved again\n"))), folder)
    return pg.read_pages(spark, folder).select("path", "site", "readable", T.text_bytes("html").alias("n_bytes"),
                                                 F.md5("html").alias("html_md5"))


def page_saves(spark, sf_dir):
    """Every page, then pages of site3 again with a line more, then some of these a third time."""
    p = pages(spark, sf_dir).select("doc_id", "path", "html")
    again = p.where(F.col("path").startswith("site3/") & (F.col("doc_id") % 3 == 0)).withColumn("html", F.concat("html", F.lit("saved again\n")))
    third = again.where(F.col("doc_id") % 2 == 0).withColumn("html", F.concat("html", F.lit("the third time\n")))
    return [p, again, third]


@query("live_lookup")
def q_live_lookup(spark, sf_dir):
    """Words of lines that come and go, looked up after each page's last save."""
    folder = scratch_path(spark, "live-index")
    for save in page_saves(spark, sf_dir):
        li.save_pages(save, folder, most=2)
    return flat_postings(li.live_postings(spark, folder, words=["again", "third", LOOKUP_WORD]))


QUERIES["stream_live_postings"] = st.stream_live_postings


@query("write_index")
def q_write_index(spark, sf_dir):
    folder = scratch_path(spark, "index")
    ist.write_index(ix.occurrences(pages(spark, sf_dir)), folder, index_parts(spark, sf_dir))
    return ist.read_index(spark, folder).select("term", "path", "row", "line_no", "tf")


@query("text_bwl")
def q_text_bwl(spark, sf_dir):
    return ln.text_bwl(read_table(spark, sf_dir, "documents"))


@query("corpus_bwl")
def q_corpus_bwl(spark, sf_dir):
    return ln.corpus_bwl(pages(spark, sf_dir))


@query("line_slices")
def q_line_slices(spark, sf_dir):
    return lay.line_slices(pages(spark, sf_dir), n_slices=4)


# --- streams ------------------------------------------------------------------

QUERIES["stream_server_stats"] = st.stream_server_stats
QUERIES["stream_seen_urls"] = st.stream_seen_urls
QUERIES["stream_requested_urls"] = st.stream_requested_urls
QUERIES["stream_postings"] = st.stream_postings
QUERIES["stream_commands"] = st.stream_commands
QUERIES["stream_answers"] = st.stream_answers


@query("search_stored")
def q_search_stored(spark, sf_dir):
    """Build the index and page store once in the shared folder, then answer
    every benchmark search from them."""
    p = pages(spark, sf_dir)
    folder = scratch_path(spark, "index")
    ist.write_index(ix.occurrences(p), folder, index_parts(spark, sf_dir))
    n = result_parts(spark, sf_dir)
    store = spark.table(ist.write_lines(p, n))
    return se.search_stored(ist.read_index(spark, folder), store, qterms(spark, sf_dir), n)


@query("search_command")
def q_search_command(spark, sf_dir):
    """Every benchmark command as typed: its kind, totals and reply."""
    raw = fx.search_queries(spark, sf_dir)
    totals = se.search_totals(se.search_summary(pages(spark, sf_dir), se.query_terms(raw)))
    logged = tr.command_log(raw).select("query_id", "kind", "reply").join(totals, "query_id", "left").na.fill(0, ["n_pages", "n_rows"])
    return logged.withColumn("reply", F.when(F.col("n_rows") == 0, F.lit(NO_RESULTS)).otherwise(F.col("reply")))


@query("search_totals")
def q_search_totals(spark, sf_dir):
    return se.search_totals(se.search_summary(pages(spark, sf_dir), qterms(spark, sf_dir)))


@query("in_degree")
def q_in_degree(spark, sf_dir):
    p = pages(spark, sf_dir)
    return gr.in_degree(gr.edges(p), p)


@query("inlink_coverage")
def q_inlink_coverage(spark, sf_dir):
    p = pages(spark, sf_dir)
    return gr.inlink_coverage(gr.edges(p), p)
