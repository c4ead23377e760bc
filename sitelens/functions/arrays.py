"""Exploding computed arrays without duplicated work.

For a plain ``explode``/``posexplode`` Catalyst infers ``size(arr) > 0`` and
pushes that filter below the projection and any exchange, which inlines the
whole array expression a second time (for pages: building, splitting and
filtering the page twice, the first time before the repartition).  The
``_outer`` generators infer nothing; their placeholder row for an empty
array is dropped right after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: list, arr: Column, name: str) -> DataFrame:
    return df.select(*keep, F.explode_outer(arr).alias(name)).where(F.col(name).isNotNull())


def posexplode_rows(df: DataFrame, keep: list, arr: Column, pos: str, name: str) -> DataFrame:
    return df.select(*keep, F.posexplode_outer(arr).alias(pos, name)).where(F.col(pos).isNotNull())
