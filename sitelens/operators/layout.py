"""Line ranges of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import explode_rows, posexplode_rows


def line_slices(pages: DataFrame, n_slices: int = 4, start: int = 0) -> DataFrame:
    """``(path, k, line_no, line)``: ``n_slices`` slices of ``len = max(n_lines
    // n_slices, 1)`` lines from ``start``; slice k covers lines ``start +
    k*len`` to ``start + (k+1)*len`` inclusive (neighbours share one line).
    Cut out of the page's own line array: no join and no shuffle."""
    ls = pages.select("path", T.lines_array("html").alias("ls"))
    size = F.greatest(F.floor(F.size("ls") / n_slices), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(n_slices - 1)), lambda k: F.struct(
        k.cast("bigint").alias("k"), (F.lit(start) + k * size).alias("lo"), F.slice("ls", F.lit(start + 1) + k * size, size + 1).alias("part")))
    slices = explode_rows(ls, ["path"], cut, "x").select("path", "x.k", "x.lo", "x.part")
    return (posexplode_rows(slices, ["path", "k", "lo"], F.col("part"), "at", "line")
            .select("path", "k", (F.col("lo") + F.col("at")).cast("bigint").alias("line_no"), "line"))
