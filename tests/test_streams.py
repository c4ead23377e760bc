"""Streaming: replayed micro-batches and restarts change nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sitelens.operators import graph as gr
from sitelens.operators import index as ix
from sitelens.session import scratch_path
from sitelens.sources import fixtures as fx
from sitelens.streaming import streams as st


def test_replayed_batch_is_idempotent(spark):
    out = scratch_path(spark, "test-replay")
    write = st._batch_sink(out)
    batch = spark.range(100).withColumn("v", F.col("id") * 2)
    write(batch, 7)
    write(batch, 7)  # the same batch id again, as after a failure
    assert st._read_batches(spark, out).count() == 100


def test_restart_in_the_middle_reprocesses_nothing(spark, small_dir):
    out = scratch_path(spark, "test-restart")
    ckpt = out + "-ckpt"
    table = spark.read.parquet(f"{small_dir}/events.parquet").select("event_id", "event_type")
    folder = scratch_path(spark, "test-restart-source")
    table.repartition(4).write.parquet(folder)
    seen = []

    def run(stop_at=None):
        sink = st._batch_sink(out)

        def write(batch, i):
            if i == stop_at:
                raise RuntimeError("lost")
            seen.append(i)
            sink(batch, i)

        src = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        st._run(src.writeStream.foreachBatch(write).option("checkpointLocation", ckpt), "restart")

    with pytest.raises(Exception):
        run(stop_at=2)
    assert seen == [0, 1]
    run()
    run()
    assert seen == [0, 1, 2, 3]
    assert st._read_batches(spark, out).count() == table.count()


def _arriving(spark, batches, name):
    """A folder to which batches of one schema arrive, one file each."""
    folder = scratch_path(spark, name)
    for b in batches:
        b.coalesce(1).write.mode("append").parquet(folder)
    return folder


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_page_that_arrives_twice_is_indexed_once(spark, small_dir):
    """Twice in a micro-batch, in a later one, and after a restart."""
    pages = fx.corpus(spark, small_dir).select("path", "html")
    some = pages.where(F.col("path").startswith("site1"))
    folder, out = _arriving(spark, [some.union(some), some], "test-twice-in"), scratch_path(spark, "test-twice")
    st._once(_stream(spark, folder, pages.schema), st.first_postings, out, "twice")
    pages.coalesce(1).write.mode("append").parquet(folder)
    found = st._once(_stream(spark, folder, pages.schema), st.first_postings, out, "twice")
    got = sorted(map(str, found.select("term", "path", "fr", "offsets").collect()))
    assert got == sorted(map(str, ix.postings(pages).collect()))


def test_a_url_is_discovered_once(spark, small_dir):
    pages = fx.corpus(spark, small_dir).select("path", "html")
    folder, out = _arriving(spark, [pages, pages.limit(50)], "test-urls-in"), scratch_path(spark, "test-urls")
    st._once(_stream(spark, folder, pages.schema), st.seen_urls, out, "urls")
    pages.limit(20).coalesce(1).write.mode("append").parquet(folder)
    urls = [r["url"] for r in st._once(_stream(spark, folder, pages.schema), st.seen_urls, out, "urls").collect()]
    assert len(urls) == len(set(urls)) == gr.edges(pages).select("dst").distinct().count()


def test_what_was_seen_is_in_the_state_store(spark, small_dir):
    """A later run reads its new rows alone, and looks its keys up in RocksDB."""
    pages = fx.corpus(spark, small_dir).select("path", "html")
    folder, out = _arriving(spark, [pages], "test-state-in"), scratch_path(spark, "test-state")
    st._once(_stream(spark, folder, pages.schema), st.seen_urls, out, "state")
    pages.limit(7).coalesce(1).write.mode("append").parquet(folder)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, st.ROCKSDB)
    try:
        q = (st.seen_urls(_stream(spark, folder, pages.schema)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    last = [p for p in q.recentProgress if p["numInputRows"]]
    state = last[-1]["stateOperators"][0]
    assert [p["numInputRows"] for p in last] == [7]
    assert state["numRowsUpdated"] == 0 and state["numRowsTotal"] == gr.edges(pages).select("dst").distinct().count()
    assert any("rocksdb" in m.lower() for m in state["customMetrics"])


def test_the_bounded_form_forgets(spark):
    at = lambda *rows: spark.createDataFrame([(u, s) for u, s in rows], "url string, s long").select("url", F.timestamp_seconds("s").alias("ts"))
    batches = [at(("a", 1000), ("a", 1001), ("b", 1002)), at(("a", 1030), ("c", 9000)), at(("d", 9001)), at(("a", 9002), ("c", 9003))]
    folder = _arriving(spark, batches, "test-bounded-in")
    out = scratch_path(spark, "test-bounded")
    got = st._once(_stream(spark, folder, batches[0].schema), lambda s: st.seen_urls_within(s, "ts", "60 seconds"), out, "bounded")
    assert sorted(r["url"] for r in got.collect()) == ["a", "a", "b", "c", "d"]


def _answered(spark, pages, cmds, log, out, ids):
    from sitelens.operators import traffic as tr
    from sitelens.sources import index_store as ist

    folder = scratch_path(spark, "test-answer-index")
    ist.write_index(ix.occurrences(pages), folder)
    table = ist.write_lines(pages, 4)
    try:
        for i in ids:
            st.answer_commands(tr.command_log(cmds[i]), ist.read_index(spark, folder), spark.table(table), log, 0, out, i)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return {r["event_id"]: (r["n_pages"], r["n_rows"], r["reply"]) for r in st._read_batches(spark, out).collect()}


def test_commands_are_answered_as_of_their_time(spark):
    from sitelens.fixed import IN_PROGRESS_REPLY, NO_RESULTS, UNKNOWN_REPLY

    pages = spark.createDataFrame([("s/p", "a b\nb c\n"), ("s/q", "b\n")], "path string, html string")
    crawled = spark.createDataFrame([("s/p", 0, 200, 8), ("s/q", 1, 200, 2), ("s/none", 1, 404, 0)], "path string, depth bigint, status int, bytes bigint")
    log = gr.crawl_log(crawled, 0, 10)  # p at 10, none at 20, q at 30
    assert [(r["fetched"], r["downloads"], r["bytes"], r["pending"]) for r in log.orderBy("ts").collect()] == [(1, 1, 8, 2), (2, 1, 8, 1), (3, 2, 10, 0)]
    cmd = lambda *rows: spark.createDataFrame(rows, "event_id long, s long, raw string").select("event_id", F.timestamp_seconds("s").alias("ts"), "raw")
    cmds = [cmd((1, 5, "STATS\r\n"), (2, 10, "STATS\r\n"), (3, 29, "SEARCH b\r\n"), (4, 12, "what\r\n")),
            cmd((5, 30, "SEARCH b b\r\n"), (6, 3700, "STATS\r\n"), (7, 31, "SEARCH zz\r\n"), (8, 32, "SEARCH c a\r\n")),
            cmd((9, 40, "SEARCH b\r\n"))]
    out = scratch_path(spark, "test-asof")
    got = _answered(spark, pages, cmds, log, out, [0, 1, 2, 1])  # the second is replayed
    assert got == {1: (None, None, "Server up for 00:00:05 , 0 downloads ,0 bytes."), 2: (None, None, "Server up for 00:00:10 , 1 downloads ,8 bytes."),
                   3: (None, None, IN_PROGRESS_REPLY), 4: (None, None, UNKNOWN_REPLY), 5: (2, 3, None), 6: (None, None, "Server up for 01:01:40 , 2 downloads ,10 bytes."),
                   7: (0, 0, NO_RESULTS), 8: (1, 2, None), 9: (2, 3, None)}
    assert st._read_batches(spark, out + "-answers").where("qkey = 'b'").count() == 3


def test_a_micro_batch_reads_its_part_of_the_log(spark):
    log = spark.range(100).select(F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.col("id").alias("v"))
    batch = lambda *s: spark.createDataFrame([(x,) for x in s], "s long").select(F.timestamp_seconds("s").alias("ts"))
    part = lambda b: sorted(r["v"] for r in st.log_between(log, b).collect())
    assert part(batch(55, 71)) == [5, 6, 7]
    assert part(batch(60, 60)) == [6] and part(batch(-5)) == [] and part(batch(-5, 3)) == [0] and part(batch()) == []
    assert part(batch(5000)) == [99]


def test_a_staged_source_has_files_as_small_as_the_table_s_splits(spark, tmp_path, monkeypatch):
    """A larger table is staged in more files, and a micro-batch takes as many more."""
    import glob

    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.repartition(10).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(st, "scratch_path", lambda spark, name: f"{tmp_path}/staged")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        splits = spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions()
        stream = st.stream_table(spark, str(tmp_path), "documents")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = glob.glob(f"{tmp_path}/staged/*.parquet")
    assert splits > 4 and splits <= len(files) < splits + 4 and len(files) % 4 == 0
    seen = []
    st._run(stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", f"{tmp_path}/ckpt"), "staged")
    assert len(seen) == 4 and sum(seen) == 4000
