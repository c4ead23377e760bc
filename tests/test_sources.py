"""Page sources and sinks: text-file scan, page writer, index store."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from sitelens.session import scratch_path
from sitelens.sources import fixtures as fx
from sitelens.sources import index_store as ist
from sitelens.sources import pages as pg
from sitelens.sources import site_files as sf


def write_text_pages(pages, root):
    """Test helper: one file per page under ``root/site/`` (small fixtures only)."""
    import os

    for r in pages.select("path", "html").toLocalIterator():
        target = os.path.join(root, r["path"])
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w", encoding="utf-8", newline="") as fh:
            fh.write(r["html"])


def test_scan_text_files_round_trip(spark, small_dir):
    corpus = fx.corpus(spark, small_dir).where(F.col("doc_id") < 60)
    root = tempfile.mkdtemp(prefix="sitelens-pages-")
    write_text_pages(corpus, root)
    got = {r["path"]: (r["site"], r["n_bytes"], r["html"]) for r in pg.scan_pages(spark, root).collect()}
    exp = {r["path"]: (r["path"].split("/")[0], len(r["html"].encode()), r["html"]) for r in corpus.collect()}
    assert got == exp
    # the catalog of the scanned folder equals the catalog of the table
    a = {tuple(r) for r in pg.site_catalog(pg.scan_pages(spark, root)).collect()}
    b = {tuple(r) for r in pg.site_catalog(corpus).collect()}
    assert a == b


def test_scan_keeps_every_name_and_only_this_level(spark):
    root = Path(tempfile.mkdtemp(prefix="sitelens names-"))
    kept = ("site0/a.html", "site0/d e.html", "site0/p+q%20r.html", "site0/é.html", "site0/_b.html", "site0/.c.html", "_site/x", ".s/_y", "site0/empty")
    for name in (*kept, "site0/sub/x.html", "top.html"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("" if name.endswith("empty") else name)
    (root / "nothing").mkdir()
    got = {r["path"]: (r["site"], r["html"]) for r in pg.scan_pages(spark, str(root)).collect()}
    assert got == {n: (n.split("/")[0], "" if n.endswith("empty") else n) for n in kept}
    assert {(r["path"], r["size"]) for r in sf.list_pages(spark, str(root)).collect()} == {(n, 0 if n.endswith("empty") else len(n.encode())) for n in kept}
    assert pg.scan_pages(spark, str(root / "nothing")).count() == 0


def test_sites_are_partitions_and_pages_are_dealt_to_all_tasks(spark, monkeypatch):
    """A site with most of the pages is listed by one task and read by many."""
    root = Path(tempfile.mkdtemp(prefix="sitelens-hot-"))
    for i in range(200):
        site = root / ("hot" if i % 10 else f"s{i}")
        site.mkdir(exist_ok=True)
        (site / f"p{i}").write_text(f"text {i}\n")
    listed = sf.list_pages(spark, str(root))
    assert listed.rdd.getNumPartitions() == 21
    per = [r["n"] for r in sf.read_files(spark, str(root)).groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per) == 200 and max(per) < 60
    monkeypatch.setattr(sf, "LISTING_PARTS", 4)
    assert sf.list_pages(spark, str(root)).rdd.getNumPartitions() == 4
    assert sf.list_pages(spark, str(root)).count() == 200


def test_exported_pages_replace_their_files(spark, small_dir):
    root = scratch_path(spark, "test-export")
    corpus = fx.corpus(spark, small_dir)
    assert sf.export_pages(corpus, root) == corpus.count()
    again = corpus.where("doc_id % 7 = 0").withColumn("html", F.lit("new é\n"))
    sf.export_pages(again, root)
    got = {r["path"]: r["html"] for r in pg.scan_pages(spark, root).collect()}
    want = {r["path"]: r["html"] for r in corpus.collect()} | {r["path"]: r["html"] for r in again.collect()}
    assert got == want


def test_other_stores_are_read_by_spark(spark):
    """Spark's reader gives the same pages, and names those that it would hide."""
    import pytest

    root = Path(tempfile.mkdtemp(prefix="sitelens-reader-"))
    for name in ("site0/a.html", "site0/d e.html", "site0/p+q%20r.html", "site0/sub/x.html", "top.html"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(name)
    read = lambda scan: sorted(map(tuple, scan(spark, str(root)).collect()))
    assert read(pg.scan_by_reader) == read(pg.scan_pages) and len(read(pg.scan_pages)) == 3
    for hidden in ("_b.html", ".c.html"):
        (root / "site0" / hidden).write_text("x")
        with pytest.raises(ValueError, match=hidden):
            pg.scan_by_reader(spark, str(root))
        (root / "site0" / hidden).unlink()


def test_a_saved_page_replaces_that_page_only(spark, small_dir):
    corpus = fx.corpus(spark, small_dir)
    folder = scratch_path(spark, "test-pages")
    pg.write_pages(corpus, folder)
    again = corpus.where(F.col("path").startswith("site3/") & (F.col("doc_id") < 40)).withColumn("html", F.lit("new\n"))
    assert 0 < again.count() < corpus.where(F.col("path").startswith("site3/")).count()
    pg.write_pages(again, folder)
    pg.write_pages(again.withColumn("html", F.lit("newer\n")), folder)
    want = {r["path"]: r["html"] for r in corpus.collect()} | {r["path"]: "newer\n" for r in again.collect()}
    assert {r["path"]: r["html"] for r in pg.read_pages(spark, folder).collect()} == want
    target = scratch_path(spark, "test-pages-compact")
    pg.compact_pages(spark, folder, target)
    assert {r["path"]: r["html"] for r in pg.read_pages(spark, target).collect()} == want


def test_a_hot_site_is_several_files(spark):
    pages = spark.range(3000).select(
        F.concat(F.lit("site"), F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 10).cast("string"), F.lit("/p"),
                 F.col("id").cast("string")).alias("path"), F.lit("text\n").alias("html"))
    folder = scratch_path(spark, "test-hot-site")
    pg.write_pages(pages, folder)
    files = spark.read.parquet(folder).where("site = 'site0'").select(F.input_file_name().alias("f")).distinct().count()
    assert files >= 3


def test_index_store_splits_a_hot_term(spark):
    occ = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("term"),
                                   F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"), F.col("id").alias("row"),
                                   F.col("id").alias("line_no"), F.lit(1).cast("bigint").alias("tf"))
    folder = scratch_path(spark, "test-hot-term")
    ist.write_index(occ, folder, n_files=10)
    stored = ist.read_index(spark, folder).withColumn("f", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("f").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    # ranges of (term, path) do not overlap, so a lookup touches neighbouring files only
    ends = stored.groupBy("f").agg(F.min(F.struct("term", "path")).alias("lo"), F.max(F.struct("term", "path")).alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))


def test_index_parts_grow_with_the_table(spark, tmp_path, monkeypatch):
    """As many parts as keep their size; the session's shuffle partitions at least."""
    from sitelens.sources import tables

    spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    stored = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    assert tables.index_parts(spark, str(tmp_path)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(tables, "PART_BYTES", 100)
    assert tables.index_parts(spark, str(tmp_path)) == -(-stored // 100)
