"""Multi-word search (OR semantics) over page tables, ranking and reports.

Plan shape for a batch of queries: a page is a row, and all that a query asks
of a page is answered in that row.  The query words, proven few, are a literal
hash table (an array of buckets); a page's terms are looked up in it, its
(query, row) pairs are made distinct and sorted as numbers, and each run of one
query is that query's result for the page: its rows, their lines out of the
page's own array, their count and their ordinals.  Nothing is shuffled, so no
line of text moves, and a word found on a third of all lines is just a look-up.
Postings and stored hits meet the queries the same way: they are gathered by
page, once each and not once for each query, and answered in the page's row.
Result lines leave a page row by row: copies of a line that several queries
show stand side by side, where a writer's compression finds them.
A page's path is its key.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows, posexplode_rows
from ..functions.urls import site_of
from ..session import broadcast_if_small, materialize
from .lines import with_indexable

from ..fixed import NO_RESULTS, RESULT_HEADER_FORMAT, RESULT_ROW_SEPARATOR
from ..fixed import QUERY_SEPARATORS as _SEPS

QUERY_SEPARATORS = f"[{_SEPS}]"


def command_words(raw) -> Column:
    """Words of a command line: text up to the first LF, split on space, CR
    and LF, empty pieces dropped (the first word is the verb)."""
    c = F.col(raw) if isinstance(raw, str) else raw
    head = F.regexp_extract(c, r"^([^\n]*)", 1)
    return F.filter(F.split(head, QUERY_SEPARATORS, -1), lambda x: x != "")


def query_terms(queries: DataFrame, raw: str = "raw", max_terms: int | None = None) -> DataFrame:
    """``(query_id, term)``: the words after the verb, duplicates removed.

    ``max_terms`` keeps only the first words (the README's limit is ten)."""
    words = command_words(raw)
    terms = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    if max_terms is not None:
        terms = F.slice(terms, 1, max_terms)
    return explode_rows(queries, ["query_id"], terms, "term").distinct()


# Tuning: most query words written into a scan predicate as literals.
IN_LIST_LIMIT = 10_000


# Buckets of the literal table of query words: one to two words each at most at that limit.
BUCKETS = 1 << 13
# A (query, row) pair as one number: rows of a page are under this.
ROWS = 1 << 32
# A (row, place) pair as one number: an array has fewer places than this.
PLACES = 1 << 31


class Probe(NamedTuple):
    """Query words ready to be joined: ``(query_id, term)``, broadcast where
    proven small, and, if they are few enough for a literal, the vocabulary,
    the queries by number ``(q, query_id)``, the table that gives a word's
    queries (JSON, see :func:`queries_of`) and the queries of each word by its
    number (JSON, see :func:`numbers_of`)."""

    frame: DataFrame
    vocab: list[str] | None
    numbered: DataFrame | None = None
    table: str | None = None
    by_word: str | None = None


def probe(qterms: DataFrame | Probe) -> Probe:
    """Probe table and query vocabulary from one bounded collect (a probe is
    handed on as it is).

    Up to ``IN_LIST_LIMIT`` (query, word) rows are collected: then the probe
    is broadcast and the vocabulary filters terms inside each row before any
    explode (``isin`` on a literal list is a hash-set lookup).  Above the
    bound nothing is collected: a size-checked probe and no pre-filter; the
    rows that come out are the same."""
    if isinstance(qterms, Probe):
        return qterms
    q = qterms.select("query_id", "term")
    rows = q.select("query_id", "term", _bucket(F.col("term")).alias("at")).limit(IN_LIST_LIMIT + 1).collect()
    if len(rows) > IN_LIST_LIMIT:
        return Probe(broadcast_if_small(q)[0], None)
    spark, kind = q.sparkSession, q.schema["query_id"].dataType.simpleString()
    number = {i: n for n, i in enumerate(dict.fromkeys(r["query_id"] for r in rows))}
    asked: dict[tuple[int, str], list[int]] = {}
    for r in rows:
        asked.setdefault((r["at"], r["term"]), []).append(number[r["query_id"]])
    table: list[list[dict]] = [[] for _ in range(BUCKETS)]
    by_word = []
    for (at, word), queries in asked.items():
        by_word.append(sorted(set(queries)))
        table[at].append({"w": word, "q": by_word[-1], "n": len(by_word) - 1})
    return Probe(F.broadcast(spark.createDataFrame([r[:2] for r in rows], q.schema)), sorted({r["term"] for r in rows}),
                 F.broadcast(spark.createDataFrame([(n, i) for i, n in number.items()], f"q bigint, query_id {kind}")), json.dumps(table), json.dumps(by_word))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def queries_of(word: Column, table: str) -> Column:
    """Numbers of the queries that ask for ``word``: its bucket of the literal
    table (one constant, whatever its size) is picked by position and searched."""
    return F.flatten(F.transform(_entries(word, table, "q:array<bigint>"), lambda e: e["q"]))


def numbers_of(word: Column, table: str) -> Column:
    """The number of ``word`` among the query words, in an array that is empty for any other."""
    return F.transform(_entries(word, table, "n:int"), lambda e: e["n"])


def _entries(word: Column, table: str, value: str) -> Column:
    buckets = F.from_json(F.lit(table), f"array<array<struct<w:string,{value}>>>")
    return F.filter(F.get(buckets, _bucket(word)), lambda e: e["w"] == word)


def query_word_filter(words: DataFrame, qterms: DataFrame | Probe, word: str = "term") -> DataFrame:
    """Rows of ``words`` whose word is one of a query's words, tagged with the
    query id (exact, case-sensitive match)."""
    return words.join(probe(qterms).frame.withColumnRenamed("term", word), word, "inner")


def page_hits(pages: DataFrame, qterms: DataFrame | Probe, **carried: Column) -> DataFrame:
    """``(query_id, path, rows)``, one row per query and page that holds any of
    its words, ``rows`` ascending, with the ``carried`` columns of the page
    (expressions of ``html`` and of ``ix``, its indexable lines).

    Few query words: all inside the page's row, no shuffle.  Above the bound
    of the literal table the page's postings meet the query words, their rows
    are gathered per query and page (combined before that shuffle), and the
    carried columns come by a join on the page's path."""
    asked = probe(qterms)
    if asked.table is None:
        from .index import postings

        base = with_indexable(pages, keep=("path", "html"))
        met = union_rows(postings(pages), asked).select("query_id", "path", "rows")
        return met.join(base.select("path", *[c.alias(k) for k, c in carried.items()]), "path") if carried else met

    return _by_query(_pairs(pages, asked, **carried), asked, list(carried))


def _pairs(pages: DataFrame, asked: Probe, **carried: Column) -> DataFrame:
    """``(path, *carried, p)``, a row a page: ``p`` its distinct (query, row)
    pairs as ascending numbers, out of the literal table of query words."""

    def numbers(z: Column, r: Column) -> Column:
        queries = F.flatten(F.transform(T.line_terms(z["line"]), lambda t: queries_of(t, asked.table)))
        return F.transform(F.array_distinct(queries), lambda q: q * F.lit(ROWS) + r.cast("bigint"))

    base = with_indexable(pages, keep=("path", "html"))
    return base.select("path", *[c.alias(k) for k, c in carried.items()], F.sort_array(F.flatten(F.transform("ix", numbers))).alias("p"))


def _met_words(pages: DataFrame, asked: Probe, **carried: Column) -> DataFrame:
    """``(path, *carried, w)``, a row a page: ``w`` the numbers of the distinct query
    words of each of its rows, a small part of the pairs that they stand for."""
    met = F.transform("ix", lambda z: F.array_distinct(F.flatten(F.transform(T.line_terms(z["line"]), lambda t: numbers_of(t, asked.table)))))
    return with_indexable(pages, keep=("path", "html")).select("path", *[c.alias(k) for k, c in carried.items()], met.alias("w"))


def _pairs_of_words(met: DataFrame, asked: Probe, *names: str) -> DataFrame:
    """:func:`_pairs` out of :func:`_met_words`."""
    by_word = F.from_json(F.lit(asked.by_word), "array<array<bigint>>")

    def numbers(words: Column, r: Column) -> Column:
        queries = F.array_distinct(F.flatten(F.transform(words, lambda n: F.get(by_word, n))))
        return F.transform(queries, lambda q: q * F.lit(ROWS) + r.cast("bigint"))

    return met.select("path", *names, F.sort_array(F.flatten(F.transform("w", numbers))).alias("p"))


def _with_runs(found: DataFrame, *keep: str) -> DataFrame:
    """``(*keep, p, st)``: with the places in ``p`` where a query's run begins."""
    # a column of its own: inside the runs' lambda it would be made anew for each pair
    split = found.select(*keep, "p", F.transform("p", lambda x: F.shiftright(x, 32)).alias("s"))
    return split.select(*keep, "p", T.sorted_runs("s").alias("st"))


def _run_end(j: Column) -> Column:
    return F.when(j + 1 < F.size("st"), F.col("st")[j + 1]).otherwise(F.size("p"))


def _by_query(found: DataFrame, asked: Probe, names: list[str]) -> DataFrame:
    """``(query_id, path, rows, *names)`` of :func:`_pairs`, a row a query and page."""

    def one(b: Column, j: Column) -> Column:
        return F.struct(F.shiftright(F.col("p")[b], 32).alias("q"), F.transform(F.slice("p", b + 1, _run_end(j) - b), lambda x: x % F.lit(ROWS)).alias("rows"))

    return (explode_rows(_with_runs(found, "path", *names), ["path", *names], F.transform("st", one), "x").select("path", *names, "x.q", "x.rows")
            .join(asked.numbered, "q").select("query_id", "path", "rows", *names))


def _by_row(found: DataFrame, asked: Probe) -> DataFrame:
    """``(query_id, path, n_rows, f, row, line)`` of :func:`_pairs` with ``lines``,
    in the order of the page's rows.  What is exploded is a number, a row and a
    place in ``p``; ordinal, count and line are picked by position after it."""

    def places(b: Column, j: Column) -> Column:
        n = _run_end(j) - b
        return F.array_repeat(b * F.lit(ROWS) + n, n)

    at = F.sort_array(F.transform("p", lambda x, i: (x % F.lit(ROWS)) * F.lit(PLACES) + i))
    made = _with_runs(found, "path", "lines").select("path", "lines", "p", F.flatten(F.transform("st", places)).alias("run"), at.alias("at"))
    place = F.col("k").bitwiseAND(F.lit(PLACES - 1)).cast("int")
    row, run = F.shiftright("k", 31), F.col("run")[place]
    return (explode_rows(made, ["path", "lines", "p", "run"], F.col("at"), "k")
            .select(F.shiftright(F.col("p")[place], 32).alias("q"), "path", (run % F.lit(ROWS)).alias("n_rows"),
                    (place - F.shiftright(run, 32)).alias("f"), row.alias("row"), F.col("lines")[row.cast("int")].alias("line"))
            .join(asked.numbered, "q").select("query_id", "path", "n_rows", "f", "row", "line"))


def _lines(compat: bool) -> Column:
    """The texts that hits show, by row: the indexable lines, or with
    ``compat`` the physical lines numbered like them (the reference's lookup)."""
    return T.lines_array("html") if compat else F.transform("ix", lambda z: z["line"])


def _with_text(met: DataFrame) -> DataFrame:
    """``(query_id, path, n_rows, f, row, line)`` from ``(query_id, path, rows, lines)``."""
    texts = met.select("query_id", "path", F.size("rows").cast("bigint").alias("n_rows"),
                       F.transform("rows", lambda r: F.struct(r.alias("row"), F.col("lines")[r.cast("int")].alias("line"))).alias("hits"))
    return (posexplode_rows(texts, ["query_id", "path", "n_rows"], F.col("hits"), "f", "x")
            .select("query_id", "path", "n_rows", F.col("f").cast("bigint").alias("f"), "x.row", "x.line"))


def search_words(pages: DataFrame, words: list[str], compat: bool = False) -> DataFrame:
    """One SEARCH with literal words: ``(path, n_rows, f, row, line)``.

    The words are a literal array, so each line is tested with
    ``arrays_overlap`` in place and the page's row answers: no join, no
    broadcast job, no shuffle."""
    ws = F.array(*[F.lit(w) for w in dict.fromkeys(words)]) if words else F.array().cast("array<string>")
    hit = F.transform("ix", lambda z, r: F.when(F.arrays_overlap(T.line_terms(z["line"]), ws), r.cast("bigint")))
    base = with_indexable(pages, keep=("path", "html")).select("path", _lines(compat).alias("lines"), F.filter(hit, lambda r: r.isNotNull()).alias("rows"))
    return _with_text(base.where(F.size("rows") > 0).withColumn("query_id", F.lit(0).cast("bigint"))).drop("query_id")


def _from_store(hits: DataFrame, store: DataFrame) -> DataFrame:
    """Result rows of ``(query_id, path, row)`` hits.  A page's hit rows are
    gathered once per query (the only removal of duplicates), meet the page's
    row of the bucketed store, which is read in place, and are numbered and
    given their lines inside that row: no window."""
    per = hits.groupBy("query_id", "path").agg(F.array_sort(F.collect_set("row")).alias("rows"))
    return _with_text(per.join(store, "path", "inner"))


def search_stored_words(index: DataFrame, store: DataFrame, words: list[str]) -> DataFrame:
    """One SEARCH with literal words against the stored index and page store:
    ``term IN (words)`` is pushed to the index scan."""
    hits = index.where(F.col("term").isin(list(dict.fromkeys(words)))).select(F.lit(0).cast("bigint").alias("query_id"), "path", "row")
    return _from_store(hits, store).drop("query_id")


def search_hits(pages: DataFrame, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, path, row, line_no)``: distinct lines holding any word of the query."""
    asked, nos = probe(qterms), F.transform("ix", lambda z: z["line_no"])
    if asked.table is not None:
        pairs = explode_rows(_pairs(pages, asked, nos=nos), ["path", "nos"], F.col("p"), "x")
        row = F.col("x") % F.lit(ROWS)
        return (pairs.select(F.shiftright("x", 32).alias("q"), "path", row.alias("row"), F.col("nos")[row.cast("int")].alias("line_no"))
                .join(asked.numbered, "q").select("query_id", "path", "row", "line_no"))
    met = page_hits(pages, asked, nos=nos)
    return explode_rows(met, ["query_id", "path"], F.transform("rows", lambda r: F.struct(r.alias("row"), F.col("nos")[r.cast("int")].alias("line_no"))), "x").select(
        "query_id", "path", "x.row", "x.line_no")


def search_rows(pages: DataFrame, qterms: DataFrame | Probe, compat: bool = False) -> DataFrame:
    """``(query_id, path, n_rows, f, row, line)``: hits with the text of the
    line, the number of hit lines of the page and the 0-based ordinal ``f``
    of the hit in its page (ascending row)."""
    asked = probe(qterms)
    if asked.table is None:
        return _with_text(page_hits(pages, asked, lines=_lines(compat)))
    return _by_row(_pairs(pages, asked, lines=_lines(compat)), asked)


def written_search(pages: DataFrame, qterms: DataFrame | Probe, compat: bool = False, n_parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`search_rows` of a search that runs once, and the ``(query_id)``
    that it answers.  A page is written as one row, its lines once and the
    numbers of the query words on each, whatever the number of queries; above
    the literal bound the result rows are.  ``n_parts`` deals the written pages
    to so many parts of the result."""
    asked = probe(qterms)
    if asked.table is None:
        rows, _ = materialize(search_rows(pages, asked, compat), "search")
        return rows, rows.select("query_id").distinct()
    met, _ = materialize(_met_words(pages, asked, lines=_lines(compat)), "search")
    words = explode_rows(met, [], F.flatten("w"), "n").distinct()
    hit = explode_rows(words, [], F.get(F.from_json(F.lit(asked.by_word), "array<array<bigint>>"), F.col("n")), "q").distinct()
    dealt = met.repartition(n_parts, "path", "lines") if n_parts else met
    return _by_row(_pairs_of_words(dealt, asked, "lines"), asked), hit.join(asked.numbered, "q").select("query_id")


def search_stored(index: DataFrame, store: DataFrame, qterms: DataFrame | Probe, n_buckets: int | None = None) -> DataFrame:
    """:func:`search_rows` against a stored index and page store
    (:mod:`sitelens.sources.index_store`): only the index row groups of the
    query words are read (a literal ``term IN`` list, pushed to the parquet
    scan, when the word count is under a checked bound) and no page is parsed.

    Then a page's hits are gathered once, whatever the number of queries that
    ask for their words, and meet the queries in the row of the page store.
    ``n_buckets`` of the store: hits are dealt to them at once, not gathered in
    the session's partitions and dealt again."""
    asked = probe(qterms)
    if asked.table is not None:
        # proven small: the words become a scan predicate pushed to parquet
        hits = index.where(F.col("term").isin(asked.vocab)).select("path", "term", "row")
        hits = (hits.repartition(n_buckets, "path") if n_buckets else hits).groupBy("path").agg(F.collect_list(F.struct("term", "row")).alias("w"))
        numbers = F.flatten(F.transform("w", lambda x: F.transform(queries_of(x["term"], asked.table), lambda q: q * F.lit(ROWS) + x["row"])))
        return _by_row(hits.join(store, "path", "inner").select("path", "lines", F.sort_array(F.array_distinct(numbers)).alias("p")), asked)
    return _from_store(index.join(asked.frame, "term", "inner").select("query_id", "path", "row"), store)


def hit_ordinal(pages: DataFrame, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, path, row, f)``."""
    return posexplode_rows(page_hits(pages, qterms), ["query_id", "path"], F.col("rows"), "f", "row").select(
        "query_id", "path", "row", F.col("f").cast("bigint").alias("f"))


def search_summary(pages: DataFrame, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, path, n_rows)``: distinct hit lines per page (the result's ``fr``)."""
    return page_hits(pages, qterms).select("query_id", "path", F.size("rows").cast("bigint").alias("n_rows"))


def search_totals(summary: DataFrame) -> DataFrame:
    """``(query_id, n_pages, n_rows)`` from :func:`search_summary`."""
    return summary.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_pages"),
                                           F.sum("n_rows").cast("bigint").alias("n_rows"))


def search_ordered(hits: DataFrame) -> DataFrame:
    """Results by path (bytewise ascending), rows ascending (a range-partitioned
    global sort).  The hits are written first: the sort reads them twice, for
    the bounds of its ranges and to deal them, and the search runs once."""
    hits, _ = materialize(hits, "hits")
    return hits.orderBy("query_id", "path", "row")


def union_rows(post: DataFrame, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, path, rows, n_rows)``: union of the offset lists of the
    query's words per page (the nested-index form of the search).

    Few query words: a page's postings of them are gathered once each and meet
    the queries in the page's row."""
    asked = probe(qterms)
    if asked.table is not None:
        pairs = page_postings(post, asked).select("path", F.sort_array(F.array_distinct(_posting_rows(asked))).alias("p"))
        return _by_query(pairs, asked, []).select("query_id", "path", "rows", F.size("rows").cast("bigint").alias("n_rows"))
    return (post.join(asked.frame, "term", "inner").groupBy("query_id", "path")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("rows"))
            .select("query_id", "path", "rows", F.size("rows").cast("bigint").alias("n_rows")))


def page_postings(post: DataFrame, asked: Probe) -> DataFrame:
    """``(path, w)``: each page's postings of the query words, a row a page."""
    return post.where(F.col("term").isin(asked.vocab)).groupBy("path").agg(F.collect_list(F.struct(*[c for c in post.columns if c != "path"])).alias("w"))


def _posting_rows(asked: Probe) -> Column:
    """The (query, row) pairs of the postings ``w`` as numbers, unsorted."""
    return F.flatten(F.transform("w", lambda x: F.flatten(F.transform(
        queries_of(x["term"], asked.table), lambda q: F.transform(x["offsets"], lambda r: q * F.lit(ROWS) + r)))))


def union_counts(post: DataFrame, asked: Probe) -> DataFrame:
    """:func:`union_rows` with ``freq``, the occurrences of the query's words,
    for a probe that has its table.

    The (query, frequency) pairs of the postings are sorted as numbers too: each
    posting has a row and a frequency, so both arrays have runs of the same
    queries in the same order."""
    counts = F.flatten(F.transform("w", lambda x: F.transform(queries_of(x["term"], asked.table), lambda q: q * F.lit(ROWS) + x["fr"])))
    pairs = page_postings(post, asked).select("path", F.sort_array(F.array_distinct(_posting_rows(asked))).alias("p"), F.sort_array(counts).alias("c"))
    split = pairs.select("path", "p", "c", *[F.transform(a, lambda x: F.shiftright(x, 32)).alias(f"s{a}") for a in "pc"])
    runs = split.select("path", "p", "c", T.sorted_runs("sp").alias("st"), T.sorted_runs("sc").alias("ct"))

    def one(b: Column, j: Column) -> Column:
        first = F.col("ct")[j]
        last = F.when(j + 1 < F.size("ct"), F.col("ct")[j + 1]).otherwise(F.size("c"))
        return F.struct(F.shiftright(F.col("p")[b], 32).alias("q"), F.transform(F.slice("p", b + 1, _run_end(j) - b), lambda x: x % F.lit(ROWS)).alias("rows"),
                        F.aggregate(F.slice("c", first + 1, last - first), F.lit(0).cast("bigint"), lambda a, x: a + x % F.lit(ROWS)).alias("freq"))

    return (explode_rows(runs, ["path"], F.transform("st", one), "x").select("path", "x.*").join(asked.numbered, "q")
            .select("query_id", "path", "rows", F.size("rows").cast("bigint").alias("n_rows"), "freq"))


def page_frequency(post: DataFrame, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, path, freq)``: occurrences of the query's words per page."""
    return (post.join(probe(qterms).frame, "term", "inner").groupBy("query_id", "path")
            .agg(F.sum("fr").cast("bigint").alias("freq")))


def top_of(df: DataFrame, key: str, k: int) -> DataFrame:
    """Top ``k`` per query by (freq desc, key asc).  ``row_number() <= k`` is
    planned with a partial per-task group limit before the shuffle, so a
    query matching every page moves at most k rows per task."""
    from pyspark.sql import Window as W

    w = W.partitionBy("query_id").orderBy(F.col("freq").desc(), F.col(key).asc())
    return (df.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
            .select("query_id", "rank", key, "freq"))


# Column of ``post`` with the sum of ``fr`` over a page's rows, and pages that are ranked first for a bound.
TOTAL = "page_fr"
FIRST_PAGES = 128


def rank_pages(post: DataFrame, qterms: DataFrame | Probe, k: int = 10) -> DataFrame:
    """``(query_id, rank, path, freq)``: pages by frequency of the query words.

    With the column ``TOTAL`` in ``post``, only (query, page) pairs that can be
    among the best are summed up, see :func:`_can_rank`."""
    asked = probe(qterms)
    if TOTAL not in post.columns:
        return top_of(page_frequency(post, asked), "path", k)
    met = _can_rank(post, asked, k).groupBy("query_id", "path").agg(F.sum("fr").cast("bigint").alias("freq"))
    return top_of(met, "path", k)


def _can_rank(post: DataFrame, asked: Probe, k: int) -> DataFrame:
    """``(query_id, path, fr)`` of the pages that may be among a query's ``k`` best.

    A page's frequency is at most its ``TOTAL``.  The pages with the greatest are
    ranked first; what a query's k-th best there has is a frequency that its
    best pages reach, ties included, so pages whose total is below it are left
    out before anything is grouped (a query with fewer than ``k`` pages there
    leaves out none).  Rows of one path that come from several pages have parts
    of its total and are always kept.  The rows are written once before."""
    counts, _ = materialize(post, "counts")
    sums, _ = materialize(counts.groupBy("path").agg(F.sum("fr").alias("every"), F.max(TOTAL).alias("most")), "page-totals")
    first = sums.orderBy(F.col("every").desc(), "path").limit(FIRST_PAGES).select("path")
    found = top_of(page_frequency(counts.join(F.broadcast(first), "path", "left_semi"), asked), "path", k)
    need = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("freq")).alias("need"))
    words, _ = materialize(asked.frame.join(F.broadcast(need), "query_id", "left"), "words-need")
    parted, n = materialize(sums.where(F.col("every") > F.col("most")).select("path", F.lit(True).alias("parted")), "parted")
    reach = F.col("need").isNull() | (F.col(TOTAL) >= F.col("need")) | F.col("path").isNull()
    if n:
        counts, reach = counts.join(broadcast_if_small(parted)[0], "path", "left"), reach | F.col("parted")
    return counts.join(broadcast_if_small(words)[0], "term").where(reach).select("query_id", "path", "fr")


def rank_sites(post: DataFrame, qterms: DataFrame | Probe, k: int = 10) -> DataFrame:
    """``(query_id, rank, site, freq)``: sites by frequency of the query words."""
    per_site = (page_frequency(post, qterms).withColumn("site", site_of("path"))
                .groupBy("query_id", "site").agg(F.sum("freq").cast("bigint").alias("freq")))
    return top_of(per_site, "site", k)


def search_report(rows: DataFrame, queries: DataFrame, answered: DataFrame | None = None) -> DataFrame:
    """``(query_id, path, f, text)``: the answer as text rows.  Per page a
    header ``path : n `` (``f`` = -1), then ``f,row,text`` rows; a query with
    no hit gets one ``No results found`` row.  Order by (query_id, path, f).

    A page's first row brings the header; the unanswered queries are those
    whose id is not in ``answered(query_id)``, see :func:`written_search`.
    Without it the text rows are written, so that the search runs once."""
    line = F.concat_ws(RESULT_ROW_SEPARATOR, F.col("f").cast("string"), F.col("row").cast("string"), F.col("line"))
    head = F.struct(F.lit(-1).cast("bigint").alias("f"), F.format_string(RESULT_HEADER_FORMAT, F.col("path"), F.col("n_rows")).alias("text"))
    body = F.struct(F.col("f"), line.alias("text"))
    both = F.when(F.col("f") == 0, F.array(head, body)).otherwise(F.array(body))
    text = explode_rows(rows, ["query_id", "path"], both, "x").select("query_id", "path", "x.f", "x.text")
    if answered is None:
        text, _ = materialize(text, "report")
        answered = text.select("query_id").distinct()
    none = (queries.select("query_id").distinct().join(answered, "query_id", "left_anti")
            .select("query_id", F.lit(None).cast("string").alias("path"), F.lit(-1).cast("bigint").alias("f"),
                    F.lit(NO_RESULTS).alias("text")))
    return text.unionByName(none)
