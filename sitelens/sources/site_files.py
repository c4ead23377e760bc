"""Pages as files: ``root/site/page``, the crawler's save folder.

Spark's file readers skip names that start with ``_`` or ``.``, so the folder is
a data source of its own: a site, or a run of sites where there are many, is a
partition, whose task lists the site's names.  The driver sees the names of the
sites, no page.  The listed pages are then dealt evenly to the tasks that read
them, so a site with a third of all pages is read by all tasks.

Folders are opened by pyarrow: local and shared file systems, S3, GCS, HDFS.  All
that runs in tasks is made inside functions, so it travels by value and workers
need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Partitions of a listing at most; sites beyond share one.
LISTING_PARTS = 10_000
#: Bytes of text that a batch of pages holds, about.
BATCH = 8 << 20
#: Stores that pyarrow opens.
SCHEMES = ("file", "s3", "gs", "hdfs")


def located(spark: SparkSession, root: str) -> tuple[str, str, str]:
    """Scheme, authority and decoded path of a folder, as Spark resolves it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    scheme = {"s3a": "s3", "s3n": "s3"}.get(uri.getScheme(), uri.getScheme())
    return scheme, uri.getAuthority() or "", uri.getPath().rstrip("/")


def _opener(scheme: str, authority: str, base: str):
    def opened():
        from pyarrow import fs

        if scheme == "file":
            return fs.LocalFileSystem(), base
        from urllib.parse import quote

        return fs.FileSystem.from_uri(f"{scheme}://{authority}{quote(base)}")

    return opened


def _listing(opened, most: int) -> type[DataSource]:
    class Sites(InputPartition):
        def __init__(self, names: list[str]):
            self.names = names

    class Reader(DataSourceReader):
        def partitions(self):
            from pyarrow import fs

            store, base = opened()
            names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(base)) if f.type == fs.FileType.Directory)
            each = max(1, -(-len(names) // most))
            return [Sites(names[i : i + each]) for i in range(0, len(names), each)] or [Sites([])]

        def read(self, partition):
            from pyarrow import fs

            store, base = opened()
            for site in partition.names:
                for f in store.get_file_info(fs.FileSelector(f"{base}/{site}")):
                    if f.type == fs.FileType.File:
                        yield f"{site}/{f.base_name}", f.size

    class SiteListing(DataSource):
        @classmethod
        def name(cls):
            return "site_listing"

        def schema(self):
            return "path string, size long"

        def reader(self, schema):
            return Reader()

    return SiteListing


def list_pages(spark: SparkSession, root: str) -> DataFrame:
    """``(path, size)`` of every file one level below each site folder of ``root``."""
    spark.dataSource.register(_listing(_opener(*located(spark, root)), LISTING_PARTS))
    return spark.read.format("site_listing").load()


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, html)`` of those files, whole; bytes that are no UTF-8 become
    replacement characters."""
    opened, batch = _opener(*located(spark, root)), BATCH

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        store, base = opened()
        for part in parts:
            paths, texts, held = [], [], 0
            for path in part.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{path}", compression=None) as f:
                    raw = f.read()
                paths.append(path)
                texts.append(raw.decode("utf-8", "replace"))
                held += len(raw)
                if held >= batch:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["path", "html"])
                    paths, texts, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["path", "html"])

    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return list_pages(spark, root).select("path").repartition(n).mapInArrow(run, "path string, html string")


def export_pages(pages: DataFrame, root: str) -> int:
    """Save each page ``(path, html)`` as its file; a page saved again replaces
    its file.  Tasks write their own pages; the number of files written."""
    spark = pages.sparkSession
    opened = _opener(*located(spark, root))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        store, base = opened()
        made: set[str] = set()
        for part in parts:
            for path, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                folder = f"{base}/{path}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{base}/{path}", compression=None) as f:
                    f.write((html or "").encode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int64())], ["n"])

    return pages.select("path", "html").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
