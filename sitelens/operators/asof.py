"""As-of join: each row with the last one known before it.

A prefix scan whose operation is "last known value", chunked like the running
sums of :mod:`.prefix`: rows of both sides are range-partitioned on (key, time)
into chunks of about equal size, a window looks back inside a chunk, and the
short table of each chunk's last known value gives what earlier chunks knew.  A
key or a moment with a third of all rows spans many chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

_CHUNK, _SIDE, _TIE, _ROW, _KNOWN = "_chunk", "_side", "_tie", "_row", "_known"


def asof_join(left: DataFrame, right: DataFrame, time: str, values: list[str], keys: list[str] | None = None,
              n_chunks: int | None = None) -> DataFrame:
    """``left`` with the ``values`` of the row of ``right`` that has the same
    ``keys`` and the greatest ``time`` not after the left row's; NULL where
    there is none.  A change at the very moment of a left row is seen.

    Of right rows at one moment the one with the greatest values (compared in
    their order) counts.  Rows of either side whose time is NULL are at no
    moment: a left one comes back with NULLs, a right one is not seen."""
    keys = keys or []
    spark = left.sparkSession
    n = n_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = F.struct(*values)
    kind = right.select(known.alias("x")).schema["x"].dataType
    key_cols = [F.col(k) for k in keys]
    l = left.select(*key_cols, F.col(time).alias(time), F.lit(1).alias(_SIDE), F.xxhash64(*left.columns).alias(_TIE),
                    F.struct(*left.columns).alias(_ROW), F.lit(None).cast(kind).alias(_KNOWN))
    r = right.where(F.col(time).isNotNull()).select(*key_cols, F.col(time).alias(time), F.lit(0).alias(_SIDE), F.lit(0).cast("bigint").alias(_TIE),
                                                  F.lit(None).cast(l.schema[_ROW].dataType).alias(_ROW), known.alias(_KNOWN))
    # the chunk ids are fixed by writing the rows: both branches must see the same ones
    ranged, _ = materialize(l.unionByName(r).repartitionByRange(n, *keys, time, _SIDE, _TIE).withColumn(_CHUNK, F.spark_partition_id()), "asof")

    last = ranged.groupBy(*keys, _CHUNK).agg(F.max_by(_KNOWN, F.when(F.col(_SIDE) == 0, F.struct(time, _KNOWN))).alias("_last"))
    # one row a key and chunk
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = last.select(*keys, _CHUNK, F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
    earlier, _ = broadcast_if_small(earlier.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(_CHUNK).alias("_c"), "_earlier"))

    inside = Window.partitionBy(*keys, _CHUNK).orderBy(time, _SIDE, _KNOWN, _TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.withColumn("_seen", F.last(_KNOWN, ignorenulls=True).over(inside)).where(F.col(_SIDE) == 1)
    met = seen.join(earlier, [F.col(_CHUNK) == F.col("_c"), *[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]], "left")
    best = F.when(F.col(time).isNotNull(), F.coalesce("_seen", "_earlier"))
    return met.select(F.col(_ROW), best.alias(_KNOWN)).select(f"{_ROW}.*", *[F.col(f"{_KNOWN}.{v}").alias(v) for v in values])
