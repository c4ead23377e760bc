"""Dense numbers for the rows of a table, without a window over all of them.

A row's number is its place in its partition plus the rows of the partitions
before; only the partitions' row counts, one row each, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# ``monotonically_increasing_id``: the partition above these bits, the place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, name: str, first: int = 0) -> DataFrame:
    """``df`` with ``name``: dense numbers from ``first`` on, in the order of
    its partitions and of the rows in them.  The rows are written once, so a
    lost executor cannot change a number that was read."""
    rows, _ = materialize(df.withColumn("at_", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at_", _PLACE_BITS)
    counts = rows.groupBy(part.alias("part_")).agg(F.count(F.lit(1)).alias("n_"))
    before = F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part_", F.coalesce(before, F.lit(0)).alias("before_"))  # one row a partition
    place = F.col("at_").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (rows.withColumn("part_", part).join(F.broadcast(starts), "part_")
            .withColumn(name, F.col("before_") + place + F.lit(first)).drop("part_", "before_", "at_"))


def ranked(df: DataFrame, keys: list[str], name: str = "rank", first: int = 1) -> DataFrame:
    """``df`` with the global rank of its rows by ``keys`` (ascending, nulls
    first; rows of equal keys get numbers of their own in any order): ranges of
    the keys are sorted each for itself and numbered on."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return numbered(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), name, first)
