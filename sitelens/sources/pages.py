"""Page sources and sinks.

A crawl's save folder is ``root/site/page`` files; a page table is
``(path, site, html, n_bytes)`` with ``path`` relative to the root.  Parquet
page tables are the scalable form (splittable, column-pruned, filter
pushdown on ``path``/``site``); the file form reads whole files, one row per
file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import text_bytes
from ..functions.urls import site_of
from .site_files import SCHEMES, located, read_files


def scan_pages(spark: SparkSession, root: str) -> DataFrame:
    """Read every file one level below each site folder of ``root``
    (non-recursive) -> ``(path, site, html, n_bytes)``.

    Names are as in the folder, whatever they start with; files above or below
    that level are not read.  Listing and reading happen in tasks
    (:mod:`.site_files`); a store that pyarrow does not open is read by Spark's
    text reader, see :func:`scan_by_reader`."""
    if located(spark, root)[0] not in SCHEMES:
        return scan_by_reader(spark, root)
    return page_table(read_files(spark, root))


def scan_by_reader(spark: SparkSession, root: str) -> DataFrame:
    """:func:`scan_pages` for any store that Spark opens.  Its readers skip
    names that start with ``_`` or ``.``: where there are such files a
    :class:`ValueError` names them, so none is lost unseen."""
    base = root.rstrip("/")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hidden = [str(f.getPath().getName()) for mark in "_." for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/*/{mark}*")) or [] if f.isFile()]
    if hidden:
        raise ValueError(f"{base}: rename these pages, whose names hide them from Spark: {', '.join(sorted(hidden)[:20])}")
    # wholetext must be given to text() itself: text() resets the option
    df = (spark.read.text(f"{base}/*/*", wholetext=True)
          .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("html")))
    # file_path is a URI: decode it ("+" is itself there) and keep what is below the root folder
    decoded = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    top = str(fs.makeQualified(folder).toUri().getPath()).rstrip("/") + "/"
    rel = F.substr(decoded, F.instr(decoded, top) + F.lit(len(top)))
    df = df.withColumn("path", rel).where(F.col("path").rlike("^[^/]+/[^/]+$"))
    return df.select("path", site_of("path").alias("site"), "html", text_bytes("html").alias("n_bytes"))


def page_table(pages: DataFrame) -> DataFrame:
    """Parquet/table form of :func:`scan_pages` from ``(path, html)`` rows."""
    return pages.select("path", site_of("path").alias("site"), "html", text_bytes("html").alias("n_bytes"))


def site_catalog(pages: DataFrame) -> DataFrame:
    """``(site, n_pages, n_bytes)``."""
    return (page_table(pages).groupBy("site")
            .agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_bytes").cast("bigint").alias("n_bytes")))


def _last_fetch(spark: SparkSession, folder: str) -> int:
    """Number of the newest save in a page store, 0 for none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [str(f.getPath().getName()) for f in fs.listStatus(path)]
    return max([0, *[int(n.partition("=")[2]) for n in names if n.startswith("fetch=")]])


def write_pages(pages: DataFrame, folder: str) -> None:
    """Save pages into a store: a page saved again replaces that page, all
    others stay.  Each save appends its rows under its number (``fetch=<n>``,
    then ``site=<site>``); readers take a page's newest.  Rows are dealt by
    ranges of (site, path), so a site with a third of all pages is many files
    written by many tasks.  One writer at a time, as one crawl saves."""
    spark = pages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = pages.withColumn("site", site_of("path")).withColumn("fetch", F.lit(_last_fetch(spark, folder) + 1))
    out.repartitionByRange(n, "site", "path").write.mode("append").partitionBy("fetch", "site").parquet(folder)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of every page of a store.  Only (path, fetch) is
    shuffled to find the replaced rows; texts meet that list, short unless
    most pages were saved again (see :func:`compact_pages`)."""
    every = spark.read.parquet(folder)
    saves = every.select("path", "fetch").distinct()
    newest = saves.groupBy("path").agg(F.max("fetch").alias("newest"))
    replaced = saves.join(newest, "path").where("fetch < newest").select("path", "fetch")
    return every.join(replaced, ["path", "fetch"], "left_anti").drop("fetch")


def compact_pages(spark: SparkSession, folder: str, target: str) -> None:
    """Write a store's newest pages as the only save of a new store."""
    write_pages(read_pages(spark, folder).drop("site"), target)
