"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

# Bytes under which a side of a join may be broadcast.  Query-term, frontier
# and chunk-offset tables are measured against it before broadcasting.
BROADCAST_BYTE_LIMIT = 64 << 20

# Spark's setting by which a query drops the files of its exchanges at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Codec of large stored tables: about two thirds of the default's bytes.
STORED = "zstd"


def get_spark(master: str | None = None, app: str = "sitelens",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Session with the settings every operator here assumes.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[*]`` with one shuffle partition per core.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master("local[*]")
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # local mode runs every task inside the driver JVM
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` (or an already set SparkContext checkpoint dir)
    wins.  Only a local session without one gets a private temporary folder;
    a cluster session without one is an error, because executors must be able
    to re-read what another executor wrote.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="sitelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sitelens-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bytes_of(df: DataFrame) -> Column:
    """Bytes of all rows: 16 a value and the bytes of its text."""
    from pyspark.sql import functions as F

    width = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0))


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only after a sum over its rows proves it is under
    ``limit`` bytes (``BROADCAST_BYTE_LIMIT``).  The frame is evaluated for
    that: give a written table or a cheap scan.

    Returns the (possibly hinted) frame and whether it was broadcast; above the
    limit the caller's join falls back to a shuffle join chosen by Spark/AQE.
    """
    from pyspark.sql import functions as F

    n = df.agg(bytes_of(df)).first()[0]
    if n <= (BROADCAST_BYTE_LIMIT if limit is None else limit):
        return F.broadcast(df), True
    return df, False


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each write in the block drops the files of its exchanges when it ends:
    else they lie beside those of the next steps until the driver happens to
    collect its garbage.  For frames that run once: another run would shuffle anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back: one job cuts the lineage (a lost executor recomputes nothing
    before this point) and an ``Observation`` returns the row count from the
    same job.  Without ``compression`` the session's codec is used."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"rows_{name}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path, compression=compression)
    n = int(obs.get.get("n", 0) or 0)
    return spark.read.schema(df.schema).parquet(path), n


def bucket_of(key, n_buckets: int) -> Column:
    """The bucket of ``key`` (Spark's own numbering) in a table of ``n_buckets``."""
    from pyspark.sql import functions as F

    return F.pmod(F.hash(key), F.lit(n_buckets))


def bucketed_table(df: DataFrame, key: str, n_buckets: int, name: str, folder: str | None = None,
                   partition: str | None = None, compression: str | None = None) -> tuple[DataFrame, str, int]:
    """Write ``df`` as an external table bucketed and sorted on ``key`` in the
    shared folder (one job).  Joins on ``key`` then read it in place and
    shuffle only the other side.  With ``partition`` the table has a partition
    column of that name, the key's :func:`bucket_of`: a partition is a bucket, and
    a broadcast side that brings the column too opens only its own.  Returns the table, its catalog name (drop it
    when done; the files stay) and its size in bytes, observed in the job."""
    spark = df.sparkSession
    table = f"sitelens_{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(n_buckets, key)
    if partition:
        dealt = dealt.withColumn(partition, bucket_of(key, n_buckets))
    n = append_bucketed(dealt, table, key, n_buckets, folder or scratch_path(spark, name), partition, compression)
    return spark.table(table), table, n


def append_bucketed(df: DataFrame, table: str, key: str, n_buckets: int, folder: str, partition: str | None = None, compression: str | None = None) -> int:
    """Append to (or create) a table of :func:`bucketed_table`; the bytes added."""
    from pyspark.sql import Observation

    obs = Observation(f"{table}_{uuid.uuid4().hex[:8]}")
    rows = df.observe(obs, bytes_of(df).alias("n")).write.format("parquet").mode("append").option("path", folder)
    if compression:
        rows = rows.option("compression", compression)
    (rows.partitionBy(partition) if partition else rows).bucketBy(n_buckets, key).sortBy(key).saveAsTable(table)
    return int(obs.get.get("n", 0) or 0)
