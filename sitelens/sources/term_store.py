"""Postings in parts, with a sorted vocabulary that says where each word lies.

Postings are range-partitioned on (``term``, ``path``) into numbered parts.  The
vocabulary has one row a word: its global rank, its pages and occurrences, and
the first and last part that hold it.  A search of any number of words meets the
vocabulary first, one row a word, and reads only the parts that the found words
lie in; words that no page holds read nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from ..operators.numbers import ranked
from ..operators.search import probe, union_counts
from ..session import broadcast_if_small, materialize

_POSTINGS, _VOCABULARY = "postings", "vocabulary"


def write_term_store(post: DataFrame, folder: str, n_parts: int | None = None) -> None:
    """Store :func:`~sitelens.operators.index.postings` and their vocabulary.

    The range keys hold the path too, so a word on a third of all pages is
    spread over many parts.  The vocabulary's counts are combined in the part
    that holds a word; sorting it moves one row a word.  The postings are
    written once before: the ranges read them twice, for their bounds and to
    deal them."""
    spark = post.sparkSession
    post, _ = materialize(post, "dealt-postings")
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (post.repartitionByRange(n, "term", "path").sortWithinPartitions("term", "path")
     .withColumn("part", F.spark_partition_id()).write.mode("overwrite").partitionBy("part").parquet(f"{folder}/{_POSTINGS}"))
    words = _postings(spark, folder).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("fr").cast("bigint").alias("cf"), F.min("part").alias("first_part"), F.max("part").alias("last_part"))
    (ranked(words, ["term"]).select("rank", "term", "df", "cf", "first_part", "last_part")
     .write.mode("overwrite").parquet(f"{folder}/{_VOCABULARY}"))


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    kind = "term string, path string, fr bigint, offsets array<bigint>, part int"  # known even where nothing was written
    return spark.read.schema(kind).parquet(f"{folder}/{_POSTINGS}")


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """``(rank, term, df, cf, first_part, last_part)``: every word once, ``rank``
    its place (from 1) in the bytewise ascending vocabulary."""
    return spark.read.parquet(f"{folder}/{_VOCABULARY}")


def vocabulary_between(spark: SparkSession, folder: str, low: int, high: int) -> DataFrame:
    """The words of ranks ``low`` to ``high``; files are sorted by rank, so their
    statistics leave out the others."""
    return vocabulary(spark, folder).where(F.col("rank").between(low, high))


def postings_of(spark: SparkSession, folder: str, qterms: DataFrame) -> DataFrame:
    """``(query_id, term, path, fr, offsets)`` of the stored words among
    ``qterms(query_id, term)``, however many there are.

    The words are found in the vocabulary by one join and written.  The numbers
    of the parts that hold them (as many as the store has parts, at most) become
    a partition filter, so other parts are not opened.  The found words are
    broadcast where their bytes prove few."""
    held, found = _held(spark, folder, qterms)
    words, _ = broadcast_if_small(found)
    return held.join(words, "term").select("query_id", "term", "path", "fr", "offsets")


def _held(spark: SparkSession, folder: str, qterms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The postings of the parts that hold a query word, and the stored words
    ``(query_id, term)``."""
    asked = qterms.select("query_id", "term")
    found, n = materialize(asked.join(vocabulary(spark, folder).drop("rank", "df", "cf"), "term"), "found-words")
    held = explode_rows(found.select("first_part", "last_part").distinct(), [], F.sequence("first_part", "last_part"), "part").distinct()
    parts = sorted(r["part"] for r in held.collect()) if n else []
    return _postings(spark, folder).where(F.col("part").isin(parts)).drop("part"), found.select("query_id", "term")


def search_terms(spark: SparkSession, folder: str, qterms: DataFrame) -> DataFrame:
    """``(query_id, path, rows, n_rows, freq)``: the pages that hold any of a
    query's words, their rows (distinct, ascending) and the words' occurrences.

    Few found words: a page's postings are gathered once each, not once a query,
    and answered in the page's row."""
    held, found = _held(spark, folder, qterms)
    asked = probe(found)
    if asked.table is not None:
        return union_counts(held, asked)
    words, _ = broadcast_if_small(found)
    met = held.join(words, "term").groupBy("query_id", "path").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("rows"), F.sum("fr").cast("bigint").alias("freq"))
    return met.select("query_id", "path", "rows", F.size("rows").cast("bigint").alias("n_rows"), "freq")
