"""Structured Streaming forms of the counters, the URL set and the index.

Sources are parquet folders read as streams; sinks are parquet folders in
the shared checkpoint folder, each query with its own ``checkpointLocation``,
so a restarted query resumes where it stopped and a replayed micro-batch
rewrites only its own output (``batch=<id>`` folders overwritten).  Each
function runs its query with ``trigger(availableNow=True)`` and returns the
sink read back as a batch DataFrame.

The reference keeps process-lifetime state with no event time, so a URL is
queued once and a page indexed once, ever.  The URLs and paths seen are kept by
Spark's state store (RocksDB), partitioned by the key: a micro-batch looks up
its own keys and reads nothing that earlier ones wrote.  Commands are answered
as of their time by an as-of join with the crawl's change log; the totals of
word sets that earlier micro-batches answered are a narrow table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NO_RESULTS
from ..operators import graph as gr
from ..operators import index as ix
from ..operators import search as se
from ..operators import traffic as tr
from ..session import broadcast_if_small, bucketed_table, materialize, scratch_path
from ..sources import fixtures as fx
from ..sources import index_store as ist
from ..sources import live_index as li
from ..sources.tables import index_parts, read_table

# Micro-batches that a registered stream's source is staged for.
SOURCE_BATCHES = 4


def batch_files(table: DataFrame, batches: int = SOURCE_BATCHES) -> int:
    """Files of a micro-batch: together the batches have at least a file for
    each split of ``table`` (a plain scan), so a file stays as small as a split."""
    return -(-table.rdd.getNumPartitions() // batches)


def stream_table(spark: SparkSession, sf_dir: str, name: str, batches: int = SOURCE_BATCHES) -> DataFrame:
    """A driver table as a stream of several micro-batches, each of as many
    files as the table's size asks for."""
    table = read_table(spark, sf_dir, name)
    folder, files = scratch_path(spark, f"source-{name}"), batch_files(table, batches)
    table.repartition(batches * files).write.parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _earlier(spark: SparkSession, out: str, batch_id: int, schema: str) -> DataFrame:
    """Rows that the micro-batches before ``batch_id`` wrote."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch long").parquet(out).where(F.col("batch") < batch_id).drop("batch")


def _run(writer, name: str) -> None:
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")


def _batch_sink(out: str, fn: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch writer: each micro-batch overwrites ``out/batch=<id>``,
    so a replay of the same batch id is idempotent."""

    def write(batch: DataFrame, batch_id: int) -> None:
        res = fn(batch) if fn else batch
        res.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def _read_batches(spark: SparkSession, out: str, schema_df: DataFrame | None = None) -> DataFrame:
    try:
        return spark.read.parquet(out).drop("batch")
    except Exception:
        if schema_df is None:
            raise
        return schema_df.limit(0)


def stream_server_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1: ``(server, served, bytes)`` over a request stream.  A micro-batch is
    counted by server and page, the pages looked up in a table bucketed on
    path that is read in place, and one row a server is written; the counters
    are the sums of those rows."""
    m = fx.pages_per_site(read_table(spark, sf_dir, "documents").select("doc_id"))
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pidx, table, _ = bucketed_table(gr.page_index(fx.corpus(spark, sf_dir)), "path", n_buckets, "stream-page-index")
    reqs = fx.requests_rows(stream_table(spark, sf_dir, "events"), m)
    out = scratch_path(spark, "stream-server-stats")
    try:
        _run(reqs.writeStream.foreachBatch(_batch_sink(out, lambda batch: tr.server_totals(batch, None, pidx)))
             .option("checkpointLocation", out + "-ckpt"), "server_stats")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
    return _read_batches(spark, out).groupBy("server").agg(F.sum("served").cast("bigint").alias("served"), F.sum("bytes").cast("bigint").alias("bytes"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Settings of a stream that keeps keys: RocksDB, and each micro-batch checkpoints its changes, not the whole state.
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _once(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], out: str, name: str) -> DataFrame:
    """Run ``fn`` of a stream into a parquet sink and read that.  What the
    query has seen is in Spark's state store (RocksDB: on the executors' disks,
    its changes in the shared checkpoint folder), not in earlier output; the
    sink's log makes each micro-batch's files count once."""
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        made = fn(stream)
        _run(made.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-ckpt"), name)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(made.schema).parquet(out)


def seen_urls(pages: DataFrame) -> DataFrame:
    """T2 on a stream of pages: each URL that they link to once, ever.  The
    state holds every URL, as the crawler's list does."""
    return gr.extract_links(pages).select(F.col("dst").alias("url")).dropDuplicates(["url"])


def seen_urls_within(urls: DataFrame, time: str, delay: str) -> DataFrame:
    """The bounded form, on a stream ``(url, time)``: a URL comes again at most
    when the watermark has passed ``delay`` since it was first seen; only the
    URLs of that time are in the state."""
    return urls.withWatermark(time, delay).dropDuplicatesWithinWatermark(["url"])


def first_postings(pages: DataFrame) -> DataFrame:
    """T3 on a stream of pages: the postings of each path's first page.  The
    state holds the paths; pages are spread by path before the work on their text."""
    return ix.postings(pages.select("path", "html").dropDuplicates(["path"]))


def stream_seen_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2: each discovered URL once, ever."""
    m = fx.pages_per_site(read_table(spark, sf_dir, "documents").select("doc_id"))
    docs = stream_table(spark, sf_dir, "documents")
    return _once(docs, lambda d: seen_urls(fx.corpus_rows(d, m)), scratch_path(spark, "stream-seen-urls"), "seen_urls")


#: The bounded form forgets a URL so long after it was first seen: longer than the event log.
FORGET = "60 days"


def stream_requested_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2, bounded: each requested URL of the request log once within :data:`FORGET`."""
    m = fx.pages_per_site(read_table(spark, sf_dir, "documents").select("doc_id"))

    def urls(events: DataFrame) -> DataFrame:
        asked = tr.request_log(fx.requests_rows(events, m)).where(~F.col("is_cmd") & F.col("req_path").isNotNull())
        return seen_urls_within(asked.select(F.col("req_path").alias("url"), "ts"), "ts", FORGET)

    return _once(stream_table(spark, sf_dir, "events"), urls, scratch_path(spark, "stream-requested-urls"), "requested_urls").select("url")


def stream_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3: pages are indexed as they arrive, each path once ever."""
    m = fx.pages_per_site(read_table(spark, sf_dir, "documents").select("doc_id"))
    docs = stream_table(spark, sf_dir, "documents")
    found = _once(docs, lambda d: first_postings(fx.corpus_rows(d, m)), scratch_path(spark, "stream-postings"), "postings")
    return found.select("term", "path", "fr", F.array_join("offsets", "-").alias("offsets_text"), F.size("offsets").cast("bigint").alias("n_offsets"))


def stream_live_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with pages that are saved again: each micro-batch is a save of the
    index that follows replaced pages (:mod:`..sources.live_index`).  The pages
    arrive in several micro-batches; when all are saved those of ``site5`` come
    once more, without the pages' last line and with a new one, and the stream
    goes on from its checkpoint."""
    files = batch_files(read_table(spark, sf_dir, "documents"))
    pages = fx.corpus(spark, sf_dir).select("doc_id", "path", "html")
    source, folder = scratch_path(spark, "source-saves"), scratch_path(spark, "stream-live-index")
    pages.repartition(SOURCE_BATCHES * files).write.parquet(source)
    again = pages.where(F.col("path").startswith("site5/")).withColumn("html", F.concat(F.replace("html", F.lit("\\t</body>\\n</html>\n"), F.lit("")), F.lit("a new line\n")))
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", files).parquet(source)

    def save(batch: DataFrame, batch_id: int) -> None:
        li.save_pages(batch, folder, batch_id, most=3)

    def follow() -> None:
        _run(stream.writeStream.foreachBatch(save).option("checkpointLocation", folder + "-ckpt"), "live_postings")

    follow()
    again.repartition(files).write.mode("append").parquet(source)
    follow()
    return li.live_postings(spark, folder).select("term", "path", "fr", F.array_join("offsets", "-").alias("offsets_text"), F.size("offsets").cast("bigint").alias("n_offsets"))


def log_between(log: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of a change log that a micro-batch can see: those of its time
    and the last one before it (two reads with a pushed filter on ``ts``)."""
    first, last = batch.agg(F.min("ts"), F.max("ts")).first()
    if last is None:
        return log.limit(0)
    before = log.where(F.col("ts") <= F.lit(first)).agg(F.max("ts")).first()[0]
    return log.where((F.col("ts") >= F.lit(before or first)) & (F.col("ts") <= F.lit(last)))


def answer_commands(logged: DataFrame, index: DataFrame, store: DataFrame, log: DataFrame, start: int, out: str, batch_id: int) -> None:
    """Answer a micro-batch of classified commands as of their times.

    The batch meets the part of the crawl's change ``log`` that it can see:
    STATS gets the counters of its moment, a SEARCH before the crawl's last
    fetch is told that the crawl runs.  Each set of search words of the other
    SEARCHes is answered once, ever: its rows go to ``out``-answers ``(qkey,
    path, n_rows, f, row, line)`` and its totals to ``out``-totals.  ``out``
    gets a row per event, ``(event_id, kind, n_pages, n_rows, reply)``."""
    spark = logged.sparkSession
    answers, totals = f"{out}-answers", f"{out}-totals"
    asof, _ = materialize(tr.crawler_asof(logged, log_between(log, logged), start).withColumn("uterms", F.array_distinct("terms")), "commands-asof")
    is_search = (F.col("kind") == "SEARCH") & (F.col("gate") == gr.READY)
    rows = asof.withColumn("qkey", F.when(is_search, F.array_join(F.array_sort("uterms"), " ")))
    asked = rows.where(is_search).select("qkey", "uterms").dropDuplicates(["qkey"])
    asked = asked.join(_earlier(spark, totals, batch_id, "qkey string, n_pages long, n_rows long").select("qkey"), "qkey", "left_anti")
    words = asked.select(F.col("qkey").alias("query_id"), F.explode_outer("uterms").alias("term")).where("term is not null")
    found = se.search_stored(index, store, words).withColumnRenamed("query_id", "qkey")
    found.write.mode("overwrite").parquet(f"{answers}/batch={batch_id}")
    found = spark.read.schema(found.schema).parquet(f"{answers}/batch={batch_id}")
    per = found.groupBy("qkey").agg(F.count(F.when(F.col("f") == 0, True)).alias("n_pages"), F.count(F.lit(1)).alias("n_rows"))
    (asked.select("qkey").join(per, "qkey", "left").na.fill(0, ["n_pages", "n_rows"])
     .write.mode("overwrite").parquet(f"{totals}/batch={batch_id}"))
    known, _ = broadcast_if_small(_earlier(spark, totals, batch_id + 1, "qkey string, n_pages long, n_rows long"))
    answered = rows.where(is_search).join(known, "qkey").select(
        "event_id", "kind", "n_pages", "n_rows", F.when(F.col("n_rows") == 0, F.lit(NO_RESULTS)).otherwise(F.col("reply")).alias("reply"))
    none = F.lit(None).cast("bigint")
    other = tr.command_replies(asof.where(~is_search)).select("event_id", "kind", none.alias("n_pages"), none.alias("n_rows"), "reply")
    answered.unionByName(other).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def run_commands(spark: SparkSession, sf_dir: str) -> str:
    """Crawl, save and index the pages, then run the command stream while the
    crawl's log tells what was fetched when; the sink folder (see
    :func:`answer_commands`).  Index, page store and log are built once."""
    pages, start = fx.corpus(spark, sf_dir), fx.first_second(spark, sf_dir)
    crawled = gr.crawl(pages, fx.START_PAGE)
    log, _ = materialize(gr.crawl_log(crawled, start, fx.FETCH_SECONDS).sort("ts"), "crawl-log")
    saved, _ = materialize(gr.fetched_pages(pages, crawled), "crawled")
    folder = scratch_path(spark, "stream-index")
    ist.write_index(ix.occurrences(saved), folder, index_parts(spark, sf_dir))
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = ist.write_lines(saved, n_buckets)
    logged = tr.command_log(fx.commands_from_events(stream_table(spark, sf_dir, "events")))
    out = scratch_path(spark, "stream-commands")
    index, store = ist.read_index(spark, folder), spark.table(table)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch, _ = materialize(batch, "commands")  # used by every step: the source is read once
        answer_commands(batch, index, store, log, start, out, batch_id)

    try:
        _run(logged.writeStream.foreachBatch(write).option("checkpointLocation", out + "-ckpt"), "commands")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
    return out


# The sink of the last command stream: both of its tables come from one run.
_ran: dict[tuple, str] = {}


def _commands(spark: SparkSession, sf_dir: str) -> str:
    """:func:`run_commands`, or its sink where this application ran it last on the same files."""
    files = [read_table(spark, sf_dir, t).select(F.col("_metadata.file_path").alias("a"), F.col("_metadata.file_size").alias("b"),
                                                 F.col("_metadata.file_modification_time").alias("c")) for t in ("documents", "events")]
    seen = files[0].unionByName(files[1]).distinct().agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b", "c"))).first()
    key = (spark.sparkContext.applicationId, *seen)
    if key not in _ran:
        out = run_commands(spark, sf_dir)
        _ran.clear()
        _ran[key] = out
    return _ran[key]


def stream_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: every command of the stream with its reply and totals."""
    return _read_batches(spark, _commands(spark, sf_dir))


def stream_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the result rows of every set of search words in the stream."""
    return _read_batches(spark, _commands(spark, sf_dir) + "-answers")
