"""Inverted index: occurrences, postings, lexicon, lookups, extreme counts.

Occurrences and postings are computed inside each page row (sort the page's
terms, cut runs), so building them never shuffles the corpus: a page's terms
are already in one task.  Only the lexicon groups across pages, and it
pre-aggregates per task before its shuffle, so a term that holds a third of
all tokens still moves one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows, posexplode_rows
from .lines import with_indexable


def occurrences(pages: DataFrame) -> DataFrame:
    """``(term, path, row, line_no, tf)``: term count per indexable line
    (the stored index grain)."""
    rows = (posexplode_rows(with_indexable(pages), ["path"], F.col("ix"), "row", "z")
            .select("path", F.col("row").cast("bigint").alias("row"), F.col("z.line_no").alias("line_no"),
                    F.sort_array(T.line_terms("z.line")).alias("s")))
    return _counted(rows, ["path", "row", "line_no"], "tf").select("term", "path", "row", "line_no", "tf")


def _counted(rows: DataFrame, keep: list[str], name: str) -> DataFrame:
    """``(*keep, term, name)``: the distinct terms of the sorted array ``s`` and
    how often each occurs.

    Most terms occur once: only repeats are cut into runs.  The terms are
    exploded as plain strings and a count is picked by position, so no struct
    is built for each of them."""
    split = rows.select(*keep, "s", T.repeats("s").alias("e"))
    split = split.select(*keep, "s", "e", T.sorted_runs("e").alias("st"))
    words = split.select(*keep, T.words_once("s", "e").alias("words"), T.repeat_counts("e", "st").alias("more"))
    at = F.col("at") - (F.size("words") - F.size("more"))
    found = posexplode_rows(words, [*keep, "words", "more"], F.col("words"), "at", "term")
    return found.select(*keep, "term", F.when(at < 0, F.lit(1).cast("bigint")).otherwise(F.get("more", at)).alias(name))


def postings(pages: DataFrame, vocab: list[str] | None = None) -> DataFrame:
    """``(term, path, fr, offsets)``: ``fr`` occurrences of the term in the
    page, ``offsets`` the sorted distinct rows holding it.

    Per page: all (term, row) pairs are sorted once, each run of one term is a
    posting; offsets are a slice of that run.
    """
    pairs = F.flatten(F.transform(
        F.col("ix"), lambda z, r: F.transform(_only(T.line_terms(z["line"]), vocab),
                                              lambda t: F.struct(t.alias("term"), r.cast("bigint").alias("row")))))
    sorted_pairs = (with_indexable(pages)
                    .select("path", F.sort_array(pairs).alias("p"))
                    .select("path", F.transform("p", lambda x: x["term"]).alias("s"),
                            F.transform("p", lambda x: x["row"]).alias("rw")))
    runs = sorted_pairs.select("path", "s", "rw", T.sorted_runs("s").alias("st"))
    n = F.size("s")

    def posting(b, j):
        end = F.when(j + 1 < F.size("st"), F.col("st")[j + 1]).otherwise(n)
        return F.struct(F.col("s")[b].alias("term"), (end - b).cast("bigint").alias("fr"),
                        F.array_distinct(F.slice("rw", b + 1, end - b)).alias("offsets"))

    return (explode_rows(runs, ["path"], F.transform("st", posting), "p")
            .select(F.col("p.term").alias("term"), "path", F.col("p.fr").alias("fr"),
                    F.col("p.offsets").alias("offsets")))


def _only(terms, vocab: list[str] | None):
    """Terms of ``vocab`` alone, inside the row and before they are sorted
    (``isin`` on a literal list is a hash-set lookup)."""
    return terms if vocab is None else F.filter(terms, lambda t: t.isin(vocab))


def page_term_counts(pages: DataFrame, vocab: list[str] | None = None, total: str | None = None) -> DataFrame:
    """``(term, path, fr)``: postings without offsets, for consumers that need
    only frequencies (lexicon, ranking, extreme counts).  Per page the terms
    are one sorted string array cut into runs: no row bookkeeping.  With
    ``vocab`` only those words' rows are produced.  ``total`` names a further
    column, the sum of ``fr`` over the page's rows."""
    terms = F.flatten(F.transform(F.col("ix"), lambda z: _only(T.line_terms(z["line"]), vocab)))
    sorted_terms = with_indexable(pages).select("path", F.sort_array(terms).alias("s"))
    if total is None:
        return _counted(sorted_terms, ["path"], "fr").select("term", "path", "fr")
    sorted_terms = sorted_terms.withColumn(total, F.size("s").cast("bigint"))
    return _counted(sorted_terms, ["path", total], "fr").select("term", "path", "fr", total)


def stored_postings(occ: DataFrame) -> DataFrame:
    """Same postings from a stored occurrence table (groups by term and page;
    filter the table first)."""
    return (occ.groupBy("term", "path")
            .agg(F.sum("tf").cast("bigint").alias("fr"), F.array_sort(F.collect_set("row")).alias("offsets")))


def lexicon(post: DataFrame) -> DataFrame:
    """``(term, df, cf)``: pages holding the term and all its occurrences."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("fr").cast("bigint").alias("cf"))


def _extreme(post: DataFrame, words: DataFrame, highest: bool) -> DataFrame:
    key = F.struct((-F.col("fr") if highest else F.col("fr")).alias("k"), F.col("path").alias("path"))
    words = words.select("term").distinct()
    best = post.join(words, "term", "left_semi").groupBy("term").agg(F.min(key).alias("b"))
    fr = (-F.col("b.k")) if highest else F.col("b.k")
    return (words.join(best, "term", "left")
            .select("term", F.coalesce(fr, F.lit(0)).cast("bigint").alias("fr"), F.col("b.path").alias("path")))


def max_count(post: DataFrame, words: DataFrame) -> DataFrame:
    """``(term, fr, path)``: page with the highest frequency of each word; a tie
    goes to the smallest path; an unknown word gives ``fr`` 0 and no path.
    ``min`` of a struct is a map-side combinable aggregate, so a word found in
    every page still moves one row per task.  ``words`` is a cheap frame (a
    probe's): it is used twice."""
    return _extreme(post, words, highest=True)


def min_count(post: DataFrame, words: DataFrame) -> DataFrame:
    """As :func:`max_count` with the lowest frequency."""
    return _extreme(post, words, highest=False)
