"""An index that follows the page store: a page saved again is indexed again.

Each save is a segment: the postings of its pages, sorted by term, their paths,
and tombstones, the (path, segment) of pages that it replaces.  A reader takes
the segments of the newest manifest and drops the postings of dead pages by an
anti-join with the tombstones, which is short unless most pages were saved again
since the last compaction.  When a save makes more than ``most`` segments, the
smallest are merged into one without their dead pages, so the number of segments
is bounded and a posting is rewritten about as often as its segment doubles.

A manifest is written last and names every segment of its state: readers go on
with the state that they read, and a save that died before its manifest never
was.  One writer at a time, as one crawl saves.  Finding the replaced pages joins
paths alone; no text is read twice.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index as ix
from ..session import broadcast_if_small, materialize

#: Segments that an index has at most after a save.
MOST_SEGMENTS = 8

_MANIFEST = "n long, segment long, rows long, batch long"
_POSTINGS = "term string, path string, fr bigint, offsets array<bigint>, segment long"


class State(NamedTuple):
    """A manifest: its number, ``{segment: postings}``, the last micro-batch
    saved (-1: none) and the highest number that a segment or manifest has."""

    n: int
    segments: dict[int, int]
    batch: int


def state(spark: SparkSession, folder: str) -> State:
    """The newest manifest of the index in ``folder``."""
    every = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest") if _exists(spark, f"{folder}/manifest") else None
    newest = every.agg(F.max("n")).first()[0] if every is not None else None
    if newest is None:
        return State(0, {}, -1)
    rows = every.where(F.col("n") == newest).collect()  # a row a segment
    return State(newest, {r["segment"]: r["rows"] for r in rows if r["segment"] is not None}, rows[0]["batch"])


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _commit(spark: SparkSession, folder: str, n: int, segments: dict[int, int], batch: int) -> State:
    rows = [(n, s, r, batch) for s, r in sorted(segments.items())] or [(n, None, None, batch)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return State(n, segments, batch)


def _table(spark: SparkSession, folder: str, kind: str, numbers: list[int], schema: str) -> DataFrame:
    """``kind`` tables of the given segments, with their number as ``segment``."""
    if not numbers:
        return spark.createDataFrame([], schema)
    base = f"{folder}/{kind}"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/segment={k}" for k in numbers])


def tombstones(spark: SparkSession, folder: str, now: State) -> DataFrame:
    """``(path, segment)`` of the pages of the state's segments that a later save replaced."""
    if not now.segments:
        return spark.createDataFrame([], "path string, segment long")
    dead = spark.read.schema("path string, of long, segment long").parquet(f"{folder}/dead").where(F.col("segment").between(min(now.segments), now.n))
    return dead.select("path", F.col("of").alias("segment")).where(F.col("segment").isin(list(now.segments)))


def _alive(rows: DataFrame, dead: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(dead)[0], ["path", "segment"], "left_anti")


def live_paths(spark: SparkSession, folder: str, now: State | None = None) -> DataFrame:
    """``(path, segment)`` of every page and the segment that indexes it."""
    now = now or state(spark, folder)
    return _alive(_table(spark, folder, "paths", sorted(now.segments), "path string, segment long"), tombstones(spark, folder, now))


def live_postings(spark: SparkSession, folder: str, now: State | None = None, words: list[str] | None = None) -> DataFrame:
    """``(term, path, fr, offsets)`` of the newest text of every page; with
    ``words`` only theirs, by a filter that reaches the scan of every segment."""
    now = now or state(spark, folder)
    rows = _table(spark, folder, "postings", sorted(now.segments), _POSTINGS)
    if words is not None:
        rows = rows.where(F.col("term").isin(words))
    return _alive(rows, tombstones(spark, folder, now)).drop("segment")


def _write(spark: SparkSession, folder: str, number: int, posts: DataFrame, paths: DataFrame) -> int:
    """A segment's two tables; its number of postings."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths.select("path").write.mode("overwrite").parquet(f"{folder}/paths/segment={number}")
    posts, _ = materialize(posts, "segment")  # the ranges read them twice, for their bounds and to deal them
    posts = posts.repartitionByRange(n, "term", "path").sortWithinPartitions("term", "path")
    posts.select("term", "path", "fr", "offsets").write.mode("overwrite").parquet(f"{folder}/postings/segment={number}")
    # from the files' footers: an observation below the exchange goes with its rows where these prove none
    return _table(spark, folder, "postings", [number], _POSTINGS).count()


def save_pages(pages: DataFrame, folder: str, batch: int | None = None, most: int = MOST_SEGMENTS) -> State:
    """Index ``pages`` ``(path, html)``: new paths are added, the others replace
    their page.  Of rows with one path the text with the smallest hash counts.

    ``batch`` is a micro-batch's number: one that was saved before (a replay
    after a failure) changes nothing."""
    spark = pages.sparkSession
    now = state(spark, folder)
    if batch is not None and batch <= now.batch:
        return now
    number = now.n + 1
    one = pages.select("path", "html").groupBy("path").agg(F.min_by("html", F.xxhash64("html")).alias("html"))
    rows = _write(spark, folder, number, ix.postings(one), one)
    new = spark.read.schema("path string").parquet(f"{folder}/paths/segment={number}")
    replaced = live_paths(spark, folder, now).join(new, "path", "left_semi")
    replaced.select("path", F.col("segment").alias("of")).write.mode("overwrite").parquet(f"{folder}/dead/segment={number}")
    now = _commit(spark, folder, number, now.segments | {number: rows}, now.batch if batch is None else batch)
    return compact(spark, folder, most) if len(now.segments) > most else now


def compact(spark: SparkSession, folder: str, most: int = MOST_SEGMENTS) -> State:
    """Merge the smallest segments into one, so that at most half of ``most``
    (at least one) are left; their dead pages and tombstones go."""
    now = state(spark, folder)
    small = sorted(now.segments, key=lambda k: (now.segments[k], k))[: max(2, len(now.segments) - max(1, most // 2) + 1)]
    if len(now.segments) < 2:
        return now
    number = now.n + 1
    part = State(now.n, {k: now.segments[k] for k in small}, now.batch)
    rows = _write(spark, folder, number, live_postings(spark, folder, part), live_paths(spark, folder, part))
    left = {k: r for k, r in now.segments.items() if k not in small}
    return _commit(spark, folder, number, left | {number: rows}, now.batch)


def clear(spark: SparkSession, folder: str) -> int:
    """Delete the tables of segments that the newest manifest no longer names
    (call it when no reader of an older state is left); how many went."""
    now, gone = state(spark, folder), 0
    jvm = spark.sparkContext._jvm
    for k in range(1, now.n + 1):
        for kind in ("postings", "paths") if k not in now.segments else ():
            path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}/segment={k}")
            gone += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return gone
