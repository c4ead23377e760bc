"""Lines, indexable rows and tokens of pages; byte/word/line counts.

Input: a page table with ``path`` and ``html``.  Each operator is per-row
array work followed by an explode, so no operator here shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows, posexplode_rows
from ..functions.urls import site_of


def page_lines(pages: DataFrame) -> DataFrame:
    """``(path, line_no, line)``: physical lines, 0-based."""
    return (posexplode_rows(pages, ["path"], T.lines_array("html"), "line_no", "line")
            .select("path", F.col("line_no").cast("bigint").alias("line_no"), "line"))


def with_indexable(pages: DataFrame, keep=("path",)) -> DataFrame:
    """Adds ``ix``: the numbered non-markup lines of each page (still nested)."""
    return pages.select(*keep, T.indexable_lines_array(T.numbered_lines(T.lines_array("html"))).alias("ix"))


def indexable_lines(pages: DataFrame) -> DataFrame:
    """``(path, row, line_no, line)``: non-markup lines with their dense
    0-based ordinal ``row`` (the index's line key) and physical ``line_no``."""
    return (posexplode_rows(with_indexable(pages), ["path"], F.col("ix"), "row", "z")
            .select("path", F.col("row").cast("bigint").alias("row"), "z.line_no", "z.line"))


def tokens(pages: DataFrame) -> DataFrame:
    """``(path, row, line_no, term)``: every term occurrence, in line order."""
    return explode_rows(indexable_lines(pages), ["path", "row", "line_no"], T.line_terms("line"), "term")


def text_bwl(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, bytes, words, lines)`` of each text."""
    return docs.select(key, T.text_bytes(text).alias("bytes"), T.text_words(text).alias("words"),
                       T.text_lines(text).alias("lines"))


def corpus_bwl(pages: DataFrame) -> DataFrame:
    """Totals of bytes, words and lines per site and overall (``site`` NULL).

    A rollup: partial sums are combined map-side, so only one row per site
    and task crosses the shuffle.
    """
    per_page = text_bwl(pages.withColumn("site", site_of("path")), key="site", text="html")
    return (per_page.rollup("site")
            .agg(F.sum("bytes").cast("bigint").alias("bytes"), F.sum("words").cast("bigint").alias("words"),
                 F.sum("lines").cast("bigint").alias("lines"), F.count(F.lit(1)).alias("n_pages")))
