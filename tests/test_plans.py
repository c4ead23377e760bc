"""Plan shapes that the scale design relies on."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import index as ix
from sitelens.operators import search as se
from sitelens.session import scratch_path
from sitelens.sources import fixtures as fx
from sitelens.sources import index_store as ist
from sitelens.sources import term_store as ts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_build_never_shuffles_pages(spark, small_dir):
    # one exchange at most: the spread of a single-split scan; none from grouping
    for df in (ix.occurrences(fx.corpus(spark, small_dir)), ix.postings(fx.corpus(spark, small_dir))):
        p = plan(df)
        assert "HashAggregate" not in p and "SortAggregate" not in p
        assert p.count("Exchange") <= 1


def test_no_inferred_filter_duplicates_page_work(spark, small_dir):
    p = plan(ix.occurrences(fx.corpus(spark, small_dir)))
    assert "Filter (size(" not in p and "size(filter(transform" not in p


def test_search_probes_broadcast_terms(spark, small_dir):
    q = se.query_terms(fx.search_queries(spark, small_dir))
    p = plan(se.search_hits(fx.corpus(spark, small_dir), q))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "SortMergeJoin" not in p


def _exchanges(df) -> list[str]:
    return [x for x in plan(df).split("\n") if "Exchange" in x and "BroadcastExchange" not in x]


def test_a_search_is_answered_in_the_page_row(spark, small_dir):
    """No hit, and so no line of text, is shuffled: the only exchange spreads the single-split scan."""
    p = fx.corpus(spark, small_dir)
    q = se.probe(se.query_terms(fx.search_queries(spark, small_dir)))
    word = q.vocab[0]
    for df in (se.search_rows(p, q), se.search_rows(p, q, compat=True), se.search_hits(p, q), se.hit_ordinal(p, q), se.search_summary(p, q), se.search_words(p, [word])):
        found = _exchanges(df)
        assert len(found) <= 1 and all("doc_id" in x for x in found), found
        assert "Window" not in plan(df) and "Aggregate" not in plan(df)
    assert "from_json" not in plan(se.search_rows(p, q))  # the table of query words is one constant


def test_long_queries_shuffle_rows_before_lines(spark, small_dir, monkeypatch):
    """Above the literal bound, hits are gathered per query and page without their text."""
    monkeypatch.setattr(se, "IN_LIST_LIMIT", 0)
    p = fx.corpus(spark, small_dir)
    df = se.search_rows(p, se.query_terms(fx.search_queries(spark, small_dir)))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    gathered = text[text.index("Aggregate [query_id"):]
    assert "collect_list(offsets" in gathered and "lines#" not in gathered.split("\n", 1)[0]


def test_lexicon_aggregates_map_side(spark, small_dir):
    df = ix.lexicon(ix.postings(fx.corpus(spark, small_dir)))
    df.write.format("noop").mode("overwrite").save()
    p = df._jdf.queryExecution().executedPlan().toString()
    # partial aggregate before the exchange on term, final after it
    assert p.count("HashAggregate") >= 2
    assert "hashpartitioning(term" in p


def test_stored_index_lookup_is_pushed_down(spark, small_dir):
    folder = scratch_path(spark, "test-index")
    ist.write_index(ix.occurrences(fx.corpus(spark, small_dir)), folder)
    df = ist.lookup(spark, folder, "the").select("path", "row")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,the)]" in text
    assert "ReadSchema: struct<term:string,path:string,row:bigint>" in text
    n = df.count()
    assert n == ix.occurrences(fx.corpus(spark, small_dir)).where(F.col("term") == "the").count()


def test_counters_read_the_bucketed_page_index_in_place(spark, small_dir):
    from sitelens.operators import graph as gr
    from sitelens.operators import traffic as tr
    from sitelens.session import bucketed_table

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the large-data path
    pidx, table, _ = bucketed_table(gr.page_index(fx.corpus(spark, small_dir)), "path", 8, "test-stream-pidx")
    try:
        text = plan(tr.server_totals(fx.requests(spark, small_dir), None, pidx))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert "Bucketed: true" in text
    lines = text.split("\n")
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    # no exchange above the bucketed scan, and requests are counted before theirs
    assert "Exchange" not in lines[scan - 1]
    assert text.index("Exchange hashpartitioning(req_path") < text.index("partial_count")


def test_a_crawl_round_moves_candidates_only(spark, small_dir):
    """Large path: bucketed links and seen URLs are read in place, one anti-join at any round."""
    from sitelens.operators import graph as gr
    from sitelens.session import bucketed_table

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    p = fx.corpus(spark, small_dir)
    links, t1, _ = bucketed_table(gr.edge_status(gr.edges(p.where("readable")), gr.page_index(p)), "src", 8, "test-links", partition=gr.LINK_PART)
    crawled = gr.crawl(p, fx.START_PAGE).withColumn("fetch", gr.fetch_path("path"))
    seen, t2, _ = bucketed_table(crawled, "path", 8, "test-seen")
    try:
        text = plan(gr.frontier_step(seen.where("depth = 3"), links, seen, small=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        for t in (t1, t2):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    assert text.count("LeftAnti") == 1
    exchanges = [x for x in text.split("\n") if "Exchange" in x]
    assert len(exchanges) == 2  # the frontier by its pages, the candidates by their paths
    lines = text.split("\n")
    for i, x in enumerate(lines):
        if "FileScan" in x and ("test_links" in x or "LeftAnti" in "".join(lines[max(0, i - 4): i])):
            assert "Exchange" not in "".join(lines[max(0, i - 3): i])


def _scans(node):
    """The file scans of a plan that ran, those of its finished stages included."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _scans(node.executedPlan())
    if "QueryStage" in name:
        return _scans(node.plan())
    if name.startswith("Scan parquet"):
        return [node]
    kids = node.children()
    return [x for i in range(kids.size()) for x in _scans(kids.apply(i))]


def test_a_small_frontier_opens_its_own_links(spark, small_dir):
    """One page in the frontier: one bucket of the links is read, by pruning at run time."""
    from sitelens.operators import graph as gr
    from sitelens.session import bucketed_table

    p = fx.corpus(spark, small_dir)
    links, t1, _ = bucketed_table(gr.edge_status(gr.edges(p.where("readable")), gr.page_index(p)), "src", 8, "test-links", partition=gr.LINK_PART)
    crawled = gr.crawl(p, fx.START_PAGE).withColumn("fetch", gr.fetch_path("path"))
    seen, t2, _ = bucketed_table(crawled, "path", 8, "test-seen")
    try:
        for depth in (0, 1):
            frontier, start = seen.where(F.col("depth") == depth), seen.where(F.col("depth") <= depth)
            step = gr.frontier_step(frontier, links, start, small=True, parts=8)
            assert "dynamicpruning" in plan(step)
            got = sorted(r.path for r in step.collect())
            assert got == sorted(r.path for r in seen.where(F.col("depth") == depth + 1).collect())
            assert got == sorted(r.path for r in gr.frontier_step(frontier, links, start).collect())
            pages = {r[0] for r in frontier.where("status = 200").select("fetch").collect()}
            held = {r[0] for r in links.where(F.col("src").isin(list(pages))).select(gr.LINK_PART).distinct().collect()}
            read = [n for n in _scans(step._jdf.queryExecution().executedPlan()) if "test_links" in n.nodeName()]
            assert len(read) == 1 and read[0].metrics().apply("numPartitions").value() <= max(len(pages), len(held))
            if depth == 0:
                assert read[0].metrics().apply("numPartitions").value() == read[0].metrics().apply("numFiles").value() == 1
    finally:
        for t in (t1, t2):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_search_report_reads_the_pages_once(spark, small_dir):
    from sitelens.plans.catalog import QUERIES

    df = QUERIES["search_report"](spark, small_dir)
    assert "documents.parquet" not in plan(df)  # the search ran once and was written


def test_results_come_in_order(spark, small_dir):
    from sitelens.plans.catalog import QUERIES

    got = [(r["query_id"], r["path"].encode(), r["row"]) for r in QUERIES["search_ordered"](spark, small_dir).collect()]
    assert got == sorted(got) and len(got) > 100


def test_long_queries_take_the_shuffled_path_to_the_same_rows(spark, small_dir, monkeypatch):
    from sitelens.plans.catalog import QUERIES

    keys = ("search_rows", "search_rows_compat", "search_hits", "hit_ordinal", "search_summary", "search_report", "rank_pages", "union_rows", "search_stored", "max_count")
    small = {k: sorted(map(str, QUERIES[k](spark, small_dir).collect())) for k in keys}
    monkeypatch.setattr(se, "IN_LIST_LIMIT", 0)
    monkeypatch.setattr("sitelens.session.BROADCAST_BYTE_LIMIT", 0)
    assert small == {k: sorted(map(str, QUERIES[k](spark, small_dir).collect())) for k in keys}


def test_query_ids_may_be_text(spark, small_dir):
    q = fx.search_queries(spark, small_dir).withColumn("query_id", F.concat(F.lit("q"), F.col("query_id").cast("string")))
    got = se.search_summary(fx.corpus(spark, small_dir), se.query_terms(q))
    assert got.schema["query_id"].dataType.simpleString() == "string" and got.count() > 0


def test_running_counters_never_window_a_whole_server(spark, small_dir):
    import re

    from sitelens.operators import traffic as tr

    df = tr.stats_asof(fx.requests(spark, small_dir), fx.corpus(spark, small_dir))
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)
    # the running sum over the request rows is partitioned by server and
    # chunk; the only window keyed by server alone is over the per-chunk
    # totals (one row per server and chunk)
    assert any("server" in keys and "_chunk" in keys for keys in windows)
    assert "_chunk" in text  # the chunked rows were written by an earlier (range-partitioned) job


def test_a_hot_page_is_split_in_the_status_lookup(spark):
    """A third of all requests ask for one page: the lookup's skewed partition is read in parts."""
    from sitelens.operators import traffic as tr

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in conf}
    page = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 500).cast("string")))
    reqs = spark.range(0, 20000, 1, 8).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit(0).cast("bigint").alias("server"),
                                              F.lit(False).alias("is_cmd"), F.concat(F.lit("Get ../"), page, F.lit(" HTTP/1.1\r\n")).alias("raw"))
    pages = spark.range(0, 500, 1, 4).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("path")).union(spark.sql("select 'hot'"))
    pages = pages.select("path", F.lit(True).alias("readable"), F.lit("text\n").alias("html"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = tr.request_status(reqs, pages)
        n = sum(r["status"] == 200 for r in df.collect())
        text = plan(df)
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skewed" in text and "skew=true" in text
    assert n == 20000


def test_stored_hits_and_postings_are_dealt_by_page_alone(spark, small_dir):
    """A hit crosses an exchange once, not once for each query that asks for its word."""
    p = fx.corpus(spark, small_dir)
    q = se.probe(se.query_terms(fx.search_queries(spark, small_dir)))
    folder, terms = scratch_path(spark, "test-dealt"), scratch_path(spark, "test-dealt-terms")
    ist.write_index(ix.occurrences(p), folder)
    table = ist.write_lines(p, 4)
    ts.write_term_store(ix.postings(p), terms)
    try:
        for df in (se.union_rows(ix.postings(p, q.vocab), q), se.search_stored(ist.read_index(spark, folder), spark.table(table), q),
                   ts.search_terms(spark, terms, q.frame)):
            found = _exchanges(df)
            assert found and not any("query_id" in x for x in found), found
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_result_lines_leave_a_page_row_by_row(spark):
    """Copies of a line shown for several queries stand side by side, each with its own ordinal and count."""
    pages = spark.createDataFrame([("s/1", "a b\nc\nb\na c\n")], "path string, html string")
    q = spark.createDataFrame([(7, "a"), (8, "b"), (8, "c"), (9, "none"), (7, "a")], "query_id long, term string")
    want = [(7, 2, 0, 0, "a b"), (8, 4, 0, 0, "a b"), (8, 4, 1, 1, "c"), (8, 4, 2, 2, "b"), (7, 2, 1, 3, "a c"), (8, 4, 3, 3, "a c")]
    got = [(r["query_id"], r["n_rows"], r["f"], r["row"], r["line"]) for r in se.search_rows(pages, q).collect()]
    assert [r[3] for r in got] == [r[3] for r in want] and sorted(got) == sorted(want)


def test_a_written_search_holds_a_page_once(spark, small_dir, monkeypatch):
    """Whatever the number of queries that show its lines; the ids that it answers are those of its rows."""
    from sitelens.session import materialize

    kept = []
    monkeypatch.setattr(se, "materialize", lambda df, name: kept.append(materialize(df, name)) or kept[-1])
    p = fx.corpus(spark, small_dir)
    q = se.query_terms(fx.search_queries(spark, small_dir).unionByName(spark.createDataFrame([(-1, "SEARCH nowhere-at-all\n")], "query_id long, raw string")))
    rows, answered = se.written_search(p, q)
    assert kept[0][1] == p.count() < rows.count()
    assert sorted(map(str, rows.collect())) == sorted(map(str, se.search_rows(p, q).collect()))
    assert {r[0] for r in answered.collect()} == {r[0] for r in rows.select("query_id").collect()} and answered.where("query_id = -1").count() == 0


def test_a_sort_of_hits_runs_the_search_once(spark, small_dir):
    df = se.search_ordered(se.search_hits(fx.corpus(spark, small_dir), se.query_terms(fx.search_queries(spark, small_dir))))
    assert "documents.parquet" not in plan(df)


def test_a_written_search_does_not_grow_with_the_queries(spark, monkeypatch):
    """Many queries of one word: a row holds the word's number once; the result leaves in the parts asked for."""
    from sitelens.session import materialize

    kept = []
    monkeypatch.setattr(se, "materialize", lambda df, name: kept.append(materialize(df, name)) or kept[-1])
    pages = spark.createDataFrame([("s/1", "a b\nc\n\nb a b\n"), ("s/2", "<html>\n"), ("s/1", "a\n"), (None, "c a\n")], "path string, html string")
    q = spark.createDataFrame([(i, w) for i in range(50) for w in "ab"[: 1 + i % 2]] + [(60, "c"), (61, "none"), (None, "b")], "query_id long, term string")
    rows, answered = se.written_search(pages, q, n_parts=5)
    assert sorted([len(x) for x in r["w"]] for r in kept[0][0].collect()) == [[], [1], [2], [2, 1, 0, 2]]
    assert kept[0][0].columns == ["path", "lines", "w"] and kept[0][1] == 4
    assert rows.rdd.getNumPartitions() == 5
    assert sorted(map(str, rows.collect())) == sorted(map(str, se.search_rows(pages, q).collect()))
    assert {r[0] for r in answered.collect()} == {r[0] for r in rows.select("query_id").collect()}


def test_a_stored_search_answers_in_small_parts(spark, small_dir, monkeypatch):
    """Parts of the result grow with the documents, and hits are dealt to them at once; the lines of a part fit a writer's dictionary."""
    from sitelens.plans.catalog import QUERIES
    from sitelens.sources import tables

    monkeypatch.setattr(tables, "RESULT_BYTES", 2000)
    n = tables.result_parts(spark, small_dir)
    df = QUERIES["search_stored"](spark, small_dir)
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _exchanges(df)
    assert len(found) == 1 and "hashpartitioning(path#" in found[0] and f", {n})" in found[0]
    assert df.rdd.getNumPartitions() == n
