"""Running (prefix) aggregates that stay balanced when one key is huge.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key in one
task; if one server or site holds a third of all rows, that task holds a
third of the data.  Here the rows are range-partitioned on (key, order) into
chunks of about equal size, so a hot key spans many chunks.  Per (key, chunk)
totals are tiny; their exclusive prefix over chunks is added to a running sum
inside each (key, chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

_CHUNK = "_chunk"


def running_sums(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column],
                 keep: Column | None = None, firsts: dict[str, str] | None = None,
                 n_chunks: int | None = None) -> DataFrame:
    """Adds inclusive running sums ``name = sum(expr)`` over rows of the same
    ``keys`` ordered by ``order`` (which must make the order total).

    ``keep`` filters the returned rows after the sums are taken (e.g. only
    command rows); ``firsts`` adds ``name = min(column)`` over the key's rows
    up to and including the row's chunk (with ``order`` led by that column,
    this is the key's first value).
    """
    spark = df.sparkSession
    n = n_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = firsts or {}
    base = df.select("*", *[e.alias(f"_v_{k}") for k, e in values.items()])
    # The chunk id is fixed once by writing the chunked rows to the shared
    # folder: both branches below must see the same assignment (a re-read
    # shuffle may be coalesced differently by AQE), and a lost executor then
    # recomputes nothing before this point.
    ranged, _ = materialize(base.repartitionByRange(n, *keys, *order).withColumn(_CHUNK, F.spark_partition_id()),
                            "chunks")

    totals = ranged.groupBy(*keys, _CHUNK).agg(
        *[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values],
        *[F.min(c).alias(f"_m_{k}") for k, c in firsts.items()])
    # one row per (key, chunk): with no key this window sees only n rows
    spec = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = spec.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    upto = spec.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(*keys, _CHUNK,
                            *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in values],
                            *[F.min(f"_m_{k}").over(upto).alias(k) for k in firsts])

    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                           Window.currentRow)
    local = ranged.select("*", *[F.sum(f"_v_{k}").over(inside).alias(f"_l_{k}") for k in values])
    if keep is not None:
        local = local.where(keep)
    offsets, _ = broadcast_if_small(offsets)
    out = local.join(offsets, [*keys, _CHUNK], "inner")
    drop = [_CHUNK] + [f"_{p}_{k}" for k in values for p in ("v", "l", "o")]
    return out.select("*", *[(F.col(f"_l_{k}") + F.col(f"_o_{k}")).alias(k) for k in values]).drop(*drop)
