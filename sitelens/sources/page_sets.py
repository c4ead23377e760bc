"""Compressed sets of pages a word, and searches by set algebra.

Pages have dense numbers.  A word's pages are stored in ranges of 32,768
numbers; in each range either as sorted places (2 bytes a page) or, where these
would be longer, as a bitmap of 4,096 bytes.  A search ORs (any of the words) or
ANDs (all of them) the sets range by range: an exchange carries one bitmap a
query, range and task, whatever the number of pages and words, and pages are
counted by the bits that are set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows
from ..operators.lines import with_indexable
from ..operators.numbers import numbered
from ..operators.search import Probe, probe
from ..session import materialize

# Bits of Spark's bitmap functions, and the number of places from which a bitmap is the shorter form.
RANGE, DENSE = 32_768, 2_048
_SETS, _PAGES = "sets", "pages"


def write_page_sets(pages: DataFrame, folder: str, n_files: int | None = None) -> None:
    """Number the pages (from 1, in the order they are read) and store each
    word's set.  A page's distinct words are found in its row.  Pages that are
    read together have neighbouring numbers, so a (word, range) group comes
    from few tasks; it holds ``RANGE`` places at most."""
    spark = pages.sparkSession
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = F.array_distinct(F.flatten(F.transform("ix", lambda z: T.line_terms(z["line"]))))
    # its rows are written there: neither reader below parses a page
    got = numbered(with_indexable(pages).select("path", words.alias("words")), "page", first=1)
    got.select("page", "path").repartitionByRange(n, "page").sortWithinPartitions("page").write.mode("overwrite").parquet(f"{folder}/{_PAGES}")
    placed = explode_rows(got, [F.bitmap_bucket_number("page").alias("range"), F.bitmap_bit_position("page").cast("smallint").alias("place")], F.col("words"), "term")
    grouped = placed.groupBy("term", "range").agg(F.sort_array(F.collect_list("place")).alias("places"))
    sets, _ = materialize(grouped, "page-places")
    sparse = sets.where(F.size("places") <= DENSE).select("term", "range", "places", F.lit(None).cast("binary").alias("bits"))
    dense = (explode_rows(sets.where(F.size("places") > DENSE), ["term", "range"], F.col("places"), "place")
             .groupBy("term", "range").agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))
             .select("term", "range", F.lit(None).cast("array<smallint>").alias("places"), "bits"))
    (sparse.unionByName(dense).repartitionByRange(n, "term", "range").sortWithinPartitions("term", "range")
     .write.mode("overwrite").parquet(f"{folder}/{_SETS}"))


def _asked_sets(spark: SparkSession, folder: str, asked: Probe) -> DataFrame:
    sets = spark.read.parquet(f"{folder}/{_SETS}")
    if asked.vocab is not None:
        sets = sets.where(F.col("term").isin(asked.vocab))
    return sets.join(asked.frame, "term")


def _one_set(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The union of both forms by ``keys``: one bitmap each, combined in the
    task before the exchange."""
    either = sets.select(*keys, "bits", F.explode_outer("places").alias("place"))
    both = either.groupBy(*keys).agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("some"), F.bitmap_or_agg("bits").alias("other"))
    # grouped by the same keys: no further exchange
    return both.select(*keys, F.explode(F.array("some", "other")).alias("bits")).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def any_word(spark: SparkSession, folder: str, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, range, bits)``: the pages that hold any word of the query."""
    return _one_set(_asked_sets(spark, folder, probe(qterms)), ["query_id", "range"])


def all_words(spark: SparkSession, folder: str, qterms: DataFrame | Probe) -> DataFrame:
    """``(query_id, range, bits)``: the pages that hold every word of the query.
    A range in which a word of the query is missing has no such page."""
    asked = probe(qterms)
    wanted = asked.frame.groupBy("query_id").agg(F.count_distinct("term").alias("wanted"))
    one = _one_set(_asked_sets(spark, folder, asked), ["query_id", "range", "term"])
    met = one.groupBy("query_id", "range").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("met"))
    return met.join(wanted, "query_id").where("met = wanted").select("query_id", "range", "bits")


def page_counts(sets: DataFrame) -> DataFrame:
    """``(query_id, n_pages)`` of queries with any page, by popcount."""
    return sets.groupBy("query_id").agg(F.sum(F.bitmap_count("bits")).alias("n_pages")).where("n_pages > 0")


def set_pages(spark: SparkSession, folder: str, sets: DataFrame) -> DataFrame:
    """``(query_id, path)``: the pages of the sets.

    A range's pages are one row, their paths by place (numbers are dense), and
    the sets meet it: what an exchange carries is one bitmap a query and range
    and each path once, never a row a page found.  A bitmap is opened there in
    words of 64 bits; words that are zero are passed over."""
    place = F.bitmap_bit_position("page").alias("place")
    names = (spark.read.parquet(f"{folder}/{_PAGES}").groupBy(F.bitmap_bucket_number("page").alias("range"))
             .agg(F.sort_array(F.collect_list(F.struct(place, "path"))).alias("at"))
             .select("range", F.transform("at", lambda x: x["path"]).alias("paths")))
    eight = F.substring("bits", F.col("w") * 8 + 1, F.lit(8))  # of binary: a copy of eight bytes
    opened = (sets.join(names, "range").select("query_id", "paths", "bits", F.explode(F.sequence(F.lit(0), F.lit(RANGE // 64 - 1))).alias("w"))
              .where(F.bitmap_count(eight) > 0)
              .select("query_id", "paths", "w", F.conv(F.hex(eight), 16, -10).cast("bigint").alias("word"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k")))
    # the first byte is the word's highest, a byte's first place its lowest bit
    held = opened.where(F.expr("shiftright(word, k)").bitwiseAND(F.lit(1)) != 0)
    return held.select("query_id", F.col("paths")[F.col("w") * 64 + F.col("k").bitwiseXOR(F.lit(56))].alias("path"))
