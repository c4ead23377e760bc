"""Hand-made edge cases (FIXTURES section 4) against the plain-Python model."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import model
from sitelens.functions.timefmt import uptime_hms
from sitelens.operators import graph as gr
from sitelens.operators import index as ix
from sitelens.operators import lines as ln
from sitelens.operators import search as se
from sitelens.operators import traffic as tr

PAGES = {
    "s0/empty.html": "",
    "s0/nofinal.html": "alpha beta",
    "s0/final.html": "alpha beta\n",
    "s0/blank.html": "one\n\n\ntwo\n",
    "s0/markup.html": "<\n<x\n\t<x tab led\n <x space led\n<html> \n\t <body>\nafter markup\n",
    "s0/spaces.html": "a  b   c\nword word word\nword again\nCR line\r\nWord word, word\n",
    "s1/utf.html": "ñandú café ñandú\nnaïve résumé\n",
    "s1/long.html": ("x " * 3000 + "\n") + ("y\n" * 500) + "x y z\n",
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(p, t, True) for p, t in PAGES.items()]
    return spark.createDataFrame(rows, "path string, html string, readable boolean")


def test_page_lines(pages):
    got = sorted(tuple(r) for r in ln.page_lines(pages).collect())
    exp = sorted((p, i, l) for p, t in PAGES.items() for i, l in enumerate(model.lines(t)))
    assert got == exp


def test_indexable_lines(pages):
    got = sorted(tuple(r) for r in ln.indexable_lines(pages).collect())
    exp = sorted((p, r, n, l) for p, t in PAGES.items() for r, n, l in model.indexable(t))
    assert got == exp
    # '<' alone, tab-led and space-led markup-like lines are kept
    kept = {r["line"] for r in ln.indexable_lines(pages).where(F.col("path") == "s0/markup.html").collect()}
    assert kept == {"<", "\t<x tab led", " <x space led", "\t <body>", "after markup"}


def test_postings_match_model(pages):
    got = {(r["term"], r["path"]): (r["fr"], list(r["offsets"])) for r in ix.postings(pages).collect()}
    assert got == model.postings(PAGES)
    # the occurrence grain adds up to the same frequencies
    occ = ix.occurrences(pages).groupBy("term", "path").agg(F.sum("tf").alias("fr"))
    assert {(r["term"], r["path"]): r["fr"] for r in occ.collect()} == {k: v[0] for k, v in got.items()}


def test_case_comma_cr_kept(pages):
    terms = {r["term"] for r in ix.postings(pages).where(F.col("path") == "s0/spaces.html").collect()}
    assert {"word", "Word", "word,", "line\r"} <= terms


def test_laws(pages):
    n_tokens = ln.tokens(pages).count()
    post = ix.postings(pages)
    assert post.agg(F.sum("fr")).first()[0] == n_tokens
    lex = ix.lexicon(post)
    assert lex.agg(F.sum("cf")).first()[0] == n_tokens
    assert lex.where("term = 'word'").first()["df"] == 1


def test_bwl(spark):
    texts = ["", "a", "a ", "a b\n", "a  b \n\nc", "  x\n y \n", "ñ é\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["bytes"], r["words"], r["lines"]) for r in ln.text_bwl(df).collect()}
    assert got == {i: model.bwl(t) for i, t in enumerate(texts)}


def _queries(spark, raws):
    return spark.createDataFrame(list(enumerate(raws)), "query_id long, raw string")


def test_search_rules(spark, pages):
    raws = ["SEARCH unknownword\r\n", "SEARCH alph\r\n", "SEARCH word word\r\n", "SEARCH \r\n",
            "SEARCH x  y\r\n", "SEARCH alpha ñandú\r\n"]
    qt = se.query_terms(_queries(spark, raws))
    hits = {(r["query_id"], r["path"], r["row"]) for r in se.search_hits(pages, qt).collect()}
    for qid, raw in enumerate(raws):
        words = raw.replace("\r", " ").replace("\n", " ").split()[1:]
        exp = model.search(PAGES, words)
        assert {(p, r) for q, p, r in hits if q == qid} == exp, raw
    assert not any(q in (0, 1, 3) for q, _, _ in hits)  # unknown, prefix, no terms


def test_search_rows_ordinals_and_text(spark, pages):
    qt = se.query_terms(_queries(spark, ["SEARCH word\r\n"]))
    rows = se.search_rows(pages, qt).orderBy("f").collect()
    assert [r["f"] for r in rows] == list(range(len(rows)))
    assert all(r["n_rows"] == len(rows) for r in rows)
    ix_lines = {(p, r): l for p, t in PAGES.items() for r, _, l in model.indexable(t)}
    assert all(ix_lines[(r["path"], r["row"])] == r["line"] for r in rows)
    compat = se.search_rows(pages, qt, compat=True).collect()
    phys = {(p, i): l for p, t in PAGES.items() for i, l in enumerate(model.lines(t))}
    assert all(phys[(r["path"], r["row"])] == r["line"] for r in compat)


def test_report_no_results(spark, pages):
    q = _queries(spark, ["SEARCH nothinghere\r\n", "SEARCH alpha\r\n"])
    rep = se.search_report(se.search_rows(pages, se.query_terms(q)), q).collect()
    assert [r["text"] for r in rep if r["query_id"] == 0] == ["No results found"]
    heads = sorted(r["text"] for r in rep if r["query_id"] == 1 and r["f"] == -1)
    assert heads == ["s0/final.html : 1 ", "s0/nofinal.html : 1 "]


def test_max_min_count_ties_and_unknown(spark):
    pages = spark.createDataFrame([("b.html", "t t\n"), ("a.html", "t t\n"), ("c.html", "t\n")], "path string, html string")
    words = spark.createDataFrame([("t",), ("zz",)], "term string")
    post = ix.postings(pages)
    mx = {r["term"]: (r["fr"], r["path"]) for r in ix.max_count(post, words).collect()}
    mn = {r["term"]: (r["fr"], r["path"]) for r in ix.min_count(post, words).collect()}
    assert mx == {"t": (2, "a.html"), "zz": (0, None)}
    assert mn == {"t": (1, "c.html"), "zz": (0, None)}


GRAPH = {
    "start.html": ('<a href="../a.html"> l</a> <a href="b.html"> m</a>\n<a href="../../c.html"> n</a>\n', True),
    "a.html": ('<a href="../start.html"> back</a>\n<a href="a.html"> self</a>\n<a href="../missing.html"> x</a>\n', True),
    "b.html": ('<a href="../locked.html"> y</a>\n<a href="../a.html"> dup</a>\n<a href="../zero.html"> z</a>\n', True),
    "c.html": ("no links here\n", True),
    "locked.html": ('<a href="../hidden.html"> h</a>\n', False),
    "zero.html": ("", True),
    "hidden.html": ("never reached\n", True),
}


@pytest.fixture(scope="module")
def graph_pages(spark):
    return spark.createDataFrame([(p, t, r) for p, (t, r) in GRAPH.items()], "path string, html string, readable boolean")


def test_links_match_model(graph_pages):
    got = sorted((r["src"], r["raw_dst"]) for r in gr.extract_links(graph_pages).collect())
    exp = sorted((p, d) for p, (t, _) in GRAPH.items() for d in model.links(t))
    assert got == exp


def test_crawl_matches_model(graph_pages):
    got = {r["path"]: (r["depth"], r["status"], r["bytes"]) for r in gr.crawl(graph_pages, "start.html").collect()}
    assert got == model.crawl(GRAPH, "start.html")
    # '../../c.html' is queued as '../c.html' and fetched as 'c.html'
    assert got["../c.html"][1] == 200 and got["locked.html"][1] == 403 and got["missing.html"][1] == 404
    assert "hidden.html" not in got  # behind an unreadable page
    stats = {r["status"]: (r["n_urls"], r["downloads"]) for r in gr.crawl_stats(gr.crawl(graph_pages, "start.html")).collect()}
    assert stats[200][1] == stats[200][0] - 1  # the zero-byte page is fetched but not counted


def test_crawl_missing_start_and_depth_limit(graph_pages):
    rows = gr.crawl(graph_pages, "nowhere.html").collect()
    assert [(r["path"], r["status"]) for r in rows] == [("nowhere.html", 404)]
    limited = gr.crawl(graph_pages, "start.html", max_depth=1)
    whole = {r["path"]: r for r in gr.crawl(graph_pages, "start.html").collect()}
    rows = limited.collect()
    # what is fetched is as in the whole crawl; what waits has no status yet
    assert {r["path"] for r in rows if r["status"] is not None} == {p for p, r in whole.items() if r["depth"] <= 1}
    assert {r["path"] for r in rows if r["status"] is None} == {p for p, r in whole.items() if r["depth"] == 2} != set()
    assert all(r["bytes"] is None and r["depth"] == 2 for r in rows if r["status"] is None)
    gate = gr.crawl_gate(limited).first()
    assert gate["pending"] == sum(r["status"] is None for r in rows) and gate["gate"] == "Crawling still in progress.Sorry."
    last = max(gr.crawl_pending(limited).collect(), key=lambda r: r["max_depth"])
    assert (last["max_depth"], last["pending"], last["gate"]) == (1, gate["pending"], gate["gate"])
    assert gr.crawl_gate(gr.crawl(graph_pages, "start.html")).first()["gate"] == "ready"


def test_deep_crawl_has_one_plan_for_all_rounds(spark, monkeypatch):
    """A chain: the seen table is compacted on the way, nothing is lost."""
    monkeypatch.setattr(gr, "COMPACT_ROUNDS", 5)
    pages = spark.createDataFrame([(f"p{i}", f'<a href="p{i + 1}">x</a>\n', True) for i in range(12)], "path string, html string, readable boolean")
    got = {r["path"]: (r["depth"], r["status"]) for r in gr.crawl(pages, "p0").collect()}
    assert got == {f"p{i}": (i, 200 if i < 12 else 404) for i in range(13)}


def test_crawl_subset_of_seen(graph_pages):
    crawled = {r["path"] for r in gr.crawl(graph_pages, "start.html").collect()}
    seen = {r["url"] for r in gr.seen_urls(gr.edges(graph_pages), "start.html").collect()}
    assert crawled <= seen


@pytest.mark.parametrize("secs,text", [(0, "00:00:00"), (59, "00:00:59"), (3600, "01:00:00"),
                                       (360000 + 61, "100:01:01")])
def test_uptime(spark, secs, text):
    assert spark.range(1).select(uptime_hms(F.lit(secs))).first()[0] == text


def test_commands(spark):
    raws = ["STATS\r\n", "SHUTDOWN\r\n", "SEARCH\r\n", "SEARCH \r\n", "stats\r\n", "SEARCH a  b\r\nc d",
            "  SEARCH x", "SEARCHx y\r\n", ""]
    df = spark.createDataFrame(list(enumerate(raws)), "event_id long, raw string")
    got = {r["event_id"]: (r["kind"], r["terms"]) for r in tr.command_log(df).collect()}
    assert got[0] == ("STATS", None) and got[1] == ("SHUTDOWN", None)
    assert got[2][0] == "UNKNOWN" and got[4][0] == "UNKNOWN" and got[7][0] == "UNKNOWN" and got[8][0] == "UNKNOWN"
    assert got[3] == ("SEARCH", []) and got[5] == ("SEARCH", ["a", "b"]) and got[6] == ("SEARCH", ["x"])


def test_request_parse(spark):
    raws = ["Get ../s/p.html HTTP/1.1\r\n\r\n", "GET ../s/p.html HTTP/1.1\r\n", "Get ../../s/p.html HTTP/1.1",
            "  Get x.html", "Getx y"]
    df = spark.createDataFrame(list(enumerate(raws)), "event_id long, raw string")
    got = {r["event_id"]: r["req_path"] for r in tr.request_log(df).collect()}
    assert got == {0: "s/p.html", 1: None, 2: "../s/p.html", 3: "x.html", 4: None}


def test_search_words_equals_batch_search(spark, pages):
    words = ["word", "alpha", "ñandú", "word"]
    one = {tuple(r) for r in se.search_words(pages, words).collect()}
    batch = se.search_rows(pages, se.query_terms(_queries(spark, ["SEARCH " + " ".join(words) + "\r\n"])))
    assert one == {tuple(r) for r in batch.drop("query_id").collect()}
    assert se.search_words(pages, []).count() == 0


def test_stored_search_equals_batch_search(spark, pages):
    from sitelens.session import scratch_path
    from sitelens.sources import index_store as ist

    idir = scratch_path(spark, "t-idx")
    ist.write_index(ix.occurrences(pages), idir, n_files=3)
    table = ist.write_lines(pages, 4)
    words = ["word", "x", "café"]
    try:
        got = {tuple(r) for r in se.search_stored_words(ist.read_index(spark, idir), spark.table(table), words).collect()}
    finally:
        spark.sql(f"DROP TABLE {table}")
    assert got == {tuple(r) for r in se.search_words(pages, words).collect()}


def test_page_term_counts_equal_postings(pages):
    a = {(r["term"], r["path"], r["fr"]) for r in ix.page_term_counts(pages).collect()}
    b = {(r["term"], r["path"], r["fr"]) for r in ix.postings(pages).collect()}
    assert a == b


def test_max_terms_option(spark):
    raw = "SEARCH " + " ".join(f"w{i}" for i in range(14)) + "\r\n"
    q = _queries(spark, [raw])
    assert {r["term"] for r in se.query_terms(q, max_terms=10).collect()} == {f"w{i}" for i in range(10)}
    assert se.query_terms(q).count() == 14
    c = tr.command_log(spark.createDataFrame([(0, raw)], "event_id long, raw string"), max_terms=10).first()
    assert c["terms"] == [f"w{i}" for i in range(10)]


def test_crawl_large_mode_equals_small_mode(graph_pages, spark, small_dir, monkeypatch):
    """With a tiny broadcast bound the crawl takes its large-data path: no
    broadcast frontier.  Same result."""
    from sitelens.sources import fixtures as fx

    small = {tuple(r) for r in gr.crawl(graph_pages, "start.html").collect()}
    corpus = fx.corpus(spark, small_dir)
    small_corpus = {tuple(r) for r in gr.crawl(corpus, fx.START_PAGE).collect()}
    monkeypatch.setattr("sitelens.session.BROADCAST_BYTE_LIMIT", 2)
    assert {tuple(r) for r in gr.crawl(graph_pages, "start.html").collect()} == small
    assert {tuple(r) for r in gr.crawl(corpus, fx.START_PAGE).collect()} == small_corpus
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("sitelens_crawl")]


def test_repeated_terms_are_counted_wherever_they_stand(spark):
    """Terms once, twice and often, in every place of the sorted line; nulls and empty lines."""
    rng = random.Random(3)
    lines = [" ".join(rng.choices("abcdefg", k=n)) for n in range(14) for _ in range(4)] + ["a a a", "a b b", "a a b", "  ", "z"]
    rows = spark.createDataFrame([("p", "\n".join(lines)), ("q", ""), ("n", None), ("p", "a a")], "path string, html string")
    want = sorted((t, path, r, n) for path, ls in (("p", lines), ("p", ["a a"])) for r, x in enumerate(ls) for t, n in Counter(x.split()).items())
    assert sorted((r.term, r.path, r.row, r.tf) for r in ix.occurrences(rows).collect()) == want
    every = Counter(t for x in lines for t in x.split())
    got = sorted((r.term, r.path, r.fr, r.of) for r in ix.page_term_counts(rows, total="of").collect())
    assert got == sorted([(t, "p", n, sum(every.values())) for t, n in every.items()] + [("a", "p", 2, 2)])


def test_a_page_is_split_into_lines_once(spark):
    df = spark.createDataFrame([("p", "a\nb\n")], "path string, html string")
    plan = ln.page_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(html") == 1
