"""Shared pieces of the training-data operators: written tables, joins on hot
keys and connected components.  Nothing here collects rows to the driver
except the bounded list of hot keys named below."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import broadcast_if_small, materialize, scratch_path
from sitelens.sources.tables import read_table, spread

__all__ = ["clean", "components", "joined_on_hot_key", "mapped", "materialize", "maybe_among", "read_table", "scratch_path", "spread", "words_regex"]

#: A word: a run of anything but ASCII white space.
words_regex = r"[^\x20\x09-\x0D]+"

#: A key is hot when it holds over 1/HOT_SHARE of the rows, so at most HOT_SHARE keys can be.
HOT_SHARE = 256
#: Below this many rows a key is never hot.
HOT_ROWS = 1000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application:
    the driver's file server hands the archive out, no shared folder is needed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    fd, name = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package on the executors.  A
    worker gives its task's memory back at the end: it idles beside the JVM
    while later stages run."""
    ship(df.sparkSession)

    def then_let_go(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _let_go()

    return df.mapInArrow(then_let_go, schema)


def _let_go() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # glibc; elsewhere there is nothing to do
    except (AttributeError, OSError):
        pass


def clean(spark: SparkSession) -> None:
    """Finished steps are written: have Spark's cleaner remove their shuffle files now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hot_keys(df: DataFrame, key: str, total: int) -> dict:
    """Keys of ``df`` with over ``total / HOT_SHARE`` rows (so HOT_SHARE keys at
    most), each with the number of parts to split it into (HOT_SHARE at most)."""
    bound = max(HOT_ROWS, total // HOT_SHARE)
    counted = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > bound)
    return {r[0]: -(-r[1] // bound) for r in counted.collect()}


def joined_on_hot_key(left: DataFrame, right: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` (``total`` rows) joined with ``right`` (one row a key) on ``key``.

    The at most HOT_SHARE keys that hold more than 1/HOT_SHARE of ``left`` are
    salted: their rows are dealt to parts by a hash of the other columns, and
    ``right`` has their row once a part.  ``left`` is read twice: give a
    written table."""
    parts = hot_keys(left, key, total)
    if not parts:
        return left.join(right, key, how)
    n = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col(key)), F.lit(1))
    others = [c for c in left.columns if c != key]
    deal = F.xxhash64(*others) if others else F.monotonically_increasing_id()  # a written table's rows keep their places
    salted = left.withColumn("salt_", F.pmod(deal, n).cast("int"))
    spread_out = right.withColumn("salt_", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
    return salted.join(spread_out, [key, "salt_"], how).drop("salt_")


def several_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """The ids whose rows hold different texts (None where there are none), by
    one narrow aggregate; broadcast where their bytes prove few."""
    tag = F.xxhash64(text_col)
    found = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id_")).agg(F.min(tag).alias("low_"), F.max(tag).alias("high_"))
    several, n = materialize(found.where("low_ <> high_").select("id_", F.lit(True).alias("several_")), "several")
    return broadcast_if_small(several)[0] if n else None


def told_apart(docs: DataFrame, several: DataFrame | None, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_, text_, tag_`` (and the carried columns as ``carry_<name>``): ``tag_``
    is a 64-bit hash of the text where rows of one id hold different texts
    (:func:`several_texts`), else 0, so (id_, tag_) names a text."""
    given = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    none = F.lit(0).cast("long")
    if several is None:
        return given.withColumn("tag_", none)
    return given.join(several, "id_", "left").withColumn("tag_", F.when(F.col("several_"), F.xxhash64("text_")).otherwise(none)).drop("several_")


#: Bits of the map that ``maybe_among`` broadcasts.
MAP_BITS = 1 << 23


def maybe_among(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key's bit is set in a map of the ids' hashes: all
    rows with such a key and, by chance, some others, for an exact join that
    follows.  The map has MAP_BITS bits in all (131,072 rows of 64 bits at
    most), so it may be broadcast whatever the number of ids."""
    at = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(MAP_BITS))
    words = ids.select(F.shiftright(at, 6).alias("word_"), (at % 64).cast("int").alias("bit_"))
    words = words.groupBy("word_").agg(F.bit_or(F.expr("shiftleft(1L, bit_)")).alias("bits_"))
    mine = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(MAP_BITS))
    met = df.withColumn("at_", mine).withColumn("word_", F.shiftright("at_", 6)).join(F.broadcast(words), "word_")
    return met.where(F.expr("(shiftright(bits_, int(at_ % 64)) & 1L) = 1")).drop("at_", "word_", "bits_")


#: Narrow rows that one task of a component round writes, at least.
ROUND_ROWS = 100_000


def _stars(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph of long ids.

    Returns ``node, component`` (the smallest id reachable) for every id that
    has an edge to another.  Alternating large-star and small-star steps: each
    step is one grouped minimum (combined before the shuffle) and one join
    whose hot nodes are split off; each round is a written table, so lost
    executors never recompute earlier rounds.  The number of rounds grows with
    the logarithm of the component size; no edge or label reaches the driver."""
    now = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    now, n = materialize(_stars(now), "cc")
    spark, seen = edges.sparkSession, None
    while n:
        parts = -(-n // ROUND_ROWS)  # few links: few tasks and files
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, _ = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(2 * parts), "ccmin")
        down = now.select(F.col("b").alias("a"), F.col("a").alias("v"))  # each node with its larger neighbours
        large = joined_on_hot_key(down, low, "a", n).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large, n_large = materialize(_stars(large).coalesce(parts), "cclarge")
        low, _ = materialize(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(2 * parts), "ccmin")
        met = joined_on_hot_key(large, low, "a", n_large)
        small = met.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now, n = materialize(_stars(small).coalesce(parts), "cc")
        clean(spark)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def with_components(df: DataFrame, labels: DataFrame, key: str, total: int, name: str = "component_id") -> DataFrame:
    """``df`` with the component of ``key`` (itself where it has no link)."""
    out = joined_on_hot_key(df, labels.select(F.col("node").alias(key), F.col("component").alias(name)), key, total, "left")
    return out.withColumn(name, F.coalesce(name, key))


def slots(spark: SparkSession) -> int:
    """Partitions to spread work over when a table has fewer splits."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

