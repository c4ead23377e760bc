"""Read the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stored bytes of a table behind one part of an index made of its words: about
# four million rows, which a task sorts in its memory.
PART_BYTES = 16 << 20
# Stored bytes of a table of texts behind one part of a result that shows its
# lines again and again: the part's distinct lines fit a parquet writer's
# dictionary (1 MB), so that the copies are written as numbers.
RESULT_BYTES = 448 << 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan that has fewer splits than task slots.

    The page operators are CPU work inside each row; a small table stored as
    one parquet row group would run as a single task.  A large input already
    has many splits and is left as it is (no shuffle).  Give a plain scan: the
    number of splits of a joined frame is known only by running the join.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots, *keys)
    return df


def index_parts(spark: SparkSession, sf_dir: str, name: str = "documents") -> int:
    """Parts for an index of a table's words: the session's shuffle partitions
    at least, and as many as keep a part's size when the table grows.  Only the
    files' lengths are listed, their content is not read."""
    return _parts(spark, sf_dir, name, PART_BYTES)


def result_parts(spark: SparkSession, sf_dir: str, name: str = "documents") -> int:
    """Parts for a result that repeats a table's lines, see :func:`index_parts`."""
    return _parts(spark, sf_dir, name, RESULT_BYTES)


def _parts(spark: SparkSession, sf_dir: str, name: str, each: int) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir.rstrip('/')}/{name}.parquet")
    stored = files.agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // each))
