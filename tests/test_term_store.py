"""Postings in parts with a ranked vocabulary, and sets of pages as bitmaps."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sitelens.operators import index as ix
from sitelens.operators import numbers
from sitelens.operators import search as se
from sitelens.session import scratch_path
from sitelens.sources import page_sets as ps
from sitelens.sources import term_store as ts


@pytest.fixture(scope="module")
def pages(spark):
    """500 pages; ``w0`` is on nearly all, the last words are rare; one page is empty, one has no path's text at all."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["Zoë", "ÿ", "\U0001f600"]
    texts = [" ".join(rng.choices(words, [2 / (i + 1) for i in range(len(words))], k=30)) + "\nw0 again w0\n" for _ in range(500)]
    return spark.createDataFrame([(f"s{i % 7}/p{i}", t) for i, t in enumerate([*texts, "", None])], "path string, html string").repartition(6)


@pytest.fixture(scope="module")
def queries(spark):
    asked = [(0, "w0"), (1, "w3"), (1, "w7"), (2, "w399"), (3, "none"), (4, "w0"), (4, "w1"), (4, "Zoë"), (5, "w2"), (5, "none")]
    return spark.createDataFrame(asked, "query_id long, term string")


@pytest.fixture(scope="module")
def terms(spark, pages):
    folder = scratch_path(spark, "test-terms")
    ts.write_term_store(ix.postings(pages), folder, 24)
    return folder


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _lists(df):
    return sorted((r.query_id, r.path, tuple(r.rows), r.n_rows) for r in df.collect())


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(1).alias("part_"), F.lit("x").alias("n_")).repartition(5)
    got = numbers.ranked(df.select("k", F.col("n_").alias("x")), ["k"]).collect()
    assert sorted((r["rank"], r["k"]) for r in got) == [(k + 1, k) for k in range(1000)]
    assert sorted(r["no"] for r in numbers.numbered(df.select("k"), "no").collect()) == list(range(1000))
    assert numbers.ranked(df.select("k").limit(0), ["k"]).count() == 0


def test_numbers_need_no_window_over_the_rows(spark):
    text = numbers.ranked(spark.range(1000).toDF("k"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    window = text[text.index("Window ["):]
    assert window.index("Aggregate") < window.index("Relation")  # only the partitions' counts meet it


def test_vocabulary_is_the_lexicon_in_order(spark, pages, terms):
    got = ts.vocabulary(spark, terms).orderBy("rank").collect()
    want = {r.term: (r.df, r.cf) for r in ix.lexicon(ix.postings(pages)).collect()}
    assert [(r.term, r.df, r.cf) for r in got] == [(t, *want[t]) for t in sorted(want, key=str.encode)]
    assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert [r.term for r in ts.vocabulary_between(spark, terms, 10, 12).orderBy("rank").collect()] == [r.term for r in got[9:12]]


def test_a_common_word_lies_in_several_parts(spark, terms):
    row = ts.vocabulary(spark, terms).where("term = 'w0'").first()
    assert row.last_part > row.first_part


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_search_from_parts(spark, pages, terms, queries, monkeypatch, limit):
    monkeypatch.setattr("sitelens.session.BROADCAST_BYTE_LIMIT", limit)
    want = _lists(se.union_rows(ix.postings(pages), queries))
    got = ts.search_terms(spark, terms, queries)
    assert _lists(got) == want
    assert _rows(got.select("query_id", "path", "freq")) == _rows(se.page_frequency(ix.postings(pages), queries))


def test_many_words_open_few_files(spark, terms):
    """20,000 words, three of which are stored: only the parts that hold those are read."""
    asked = spark.range(20_000).select(F.lit(1).cast("bigint").alias("query_id"), F.concat(F.lit("absent"), "id").alias("term"))
    asked = asked.union(spark.createDataFrame([(1, "w300"), (1, "w301"), (1, "w302")], "query_id long, term string"))
    met = ts.postings_of(spark, terms, asked)
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", met._jdf.queryExecution().executedPlan().toString())
    named = next(re.findall(r"part#\d+ (?:IN|=) \(?([\d,]+)", x) for x in filters if "part#" in x)
    held = ts.vocabulary(spark, terms).where("term in ('w300', 'w301', 'w302')").collect()
    parts = {p for r in held for p in range(r.first_part, r.last_part + 1)}
    assert {int(x) for x in named[0].split(",")} == parts
    assert len(parts) < ts._postings(spark, terms).select("part").distinct().count() / 4
    assert {r.term for r in met.collect()} == {r.term for r in held}


def test_absent_words_and_an_empty_store(spark, pages, terms):
    none = spark.createDataFrame([(1, "nowhere"), (2, None)], "query_id long, term string")
    assert ts.search_terms(spark, terms, none).count() == 0
    folder = scratch_path(spark, "test-terms-empty")
    ts.write_term_store(ix.postings(pages.limit(0)), folder)
    assert ts.vocabulary(spark, folder).count() == 0
    assert ts.search_terms(spark, folder, none).count() == 0


@pytest.mark.parametrize("dense", [0, 3, 2048])
def test_page_sets_equal_the_summary(spark, pages, queries, monkeypatch, dense):
    """Both stored forms, mixed and each alone."""
    monkeypatch.setattr(ps, "DENSE", dense)
    folder = scratch_path(spark, "test-sets")
    ps.write_page_sets(pages, folder)
    want = _rows(se.search_summary(pages, queries).select("query_id", "path"))
    some = ps.any_word(spark, folder, queries)
    assert _rows(ps.set_pages(spark, folder, some)) == want
    assert dict(_rows(ps.page_counts(some))) == {q: sum(x == q for x, _ in want) for q, _ in want}
    words: dict = {}
    for q, t in queries.collect():
        words.setdefault(q, set()).add(t)
    held: dict = {}
    for r in ix.postings(pages).collect():
        held.setdefault(r.path, set()).add(r.term)
    every = sorted((q, p) for q, ws in words.items() for p, ts_ in held.items() if ws <= ts_)
    assert _rows(ps.set_pages(spark, folder, ps.all_words(spark, folder, queries))) == every


def test_page_numbers_cross_ranges(spark):
    """More pages than a range has bits: places, ranges and numbers agree."""
    n = ps.RANGE + 500
    many = spark.range(n).select(F.concat(F.lit("s/p"), "id").alias("path"),
                                 F.concat(F.when(F.col("id") % 3 == 0, "fizz ").otherwise(""), F.lit("all\n")).alias("html"))
    folder = scratch_path(spark, "test-sets-many")
    ps.write_page_sets(many, folder)
    asked = spark.createDataFrame([(1, "fizz"), (2, "all"), (3, "fizz"), (3, "all")], "query_id long, term string")
    third = (n + 2) // 3
    assert dict(_rows(ps.page_counts(ps.any_word(spark, folder, asked)))) == {1: third, 2: n, 3: n}
    assert dict(_rows(ps.page_counts(ps.all_words(spark, folder, asked)))) == {1: third, 2: n, 3: third}
    got = ps.set_pages(spark, folder, ps.any_word(spark, folder, asked.where("query_id = 1")))
    assert got.select("path").exceptAll(many.where("html like 'fizz%'").select("path")).count() == 0 and got.count() == third


def test_union_is_combined_before_its_exchange(spark, pages, queries):
    folder = scratch_path(spark, "test-sets-plan")
    ps.write_page_sets(pages, folder)
    text = ps.any_word(spark, folder, queries)._jdf.queryExecution().executedPlan().toString()
    found = [x for x in text.split("\n") if "Exchange hashpartitioning" in x]
    assert len(found) == 1 and "partial_bitmap" in text


def test_no_pages(spark, pages, queries):
    folder = scratch_path(spark, "test-sets-empty")
    ps.write_page_sets(pages.limit(0), folder)
    assert ps.page_counts(ps.any_word(spark, folder, queries)).count() == 0
    assert ps.set_pages(spark, folder, ps.all_words(spark, folder, queries)).count() == 0


def test_opened_sets_meet_ranges_not_pages(spark, pages, queries):
    """No exchange carries a row for each page found: sets and page names meet by range."""
    folder = scratch_path(spark, "test-sets-open")
    ps.write_page_sets(pages, folder)
    text = ps.set_pages(spark, folder, ps.any_word(spark, folder, queries))._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in text.split("\n") if "Join" in x and "page" in x.split("Join")[1]]
    assert not joins and "range" in text


def test_every_place_of_a_word_is_opened(spark):
    """Each of a range's first 200 places alone, the sign bit of a word among them."""
    pages = spark.range(200).select(F.concat(F.lit("s/p"), "id").alias("path"), F.concat(F.lit("w"), "id", F.lit(" x\n")).alias("html"))
    asked = spark.createDataFrame([(i, f"w{i}") for i in range(200)], "query_id long, term string")
    folder = scratch_path(spark, "test-sets-places")
    ps.write_page_sets(pages, folder)
    assert _rows(ps.set_pages(spark, folder, ps.any_word(spark, folder, asked))) == sorted((i, f"s/p{i}") for i in range(200))
