"""As-of join against a plain version."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sitelens.operators.asof import asof_join


def brute(left, right, keyed):
    out = []
    for k, t, i in left:
        known = [(rt, v, w) for rk, rt, v, w in right if t is not None and rt is not None and rt <= t and (not keyed or rk == k)]
        best = max(known, key=lambda x: (x[0], x[1], x[2]), default=(None, None, None))
        out.append((k, t, i, best[1], best[2]))
    return sorted(map(str, out))


@pytest.mark.parametrize("keyed", [True, False])
def test_against_every_row(spark, keyed):
    """A hot key, a hot moment, gaps longer than a chunk, equal times on both sides."""
    rng = random.Random(3)
    key = lambda: 0 if rng.random() < 0.4 else rng.randrange(5)
    left = [(key(), 500 if rng.random() < 0.3 else rng.randrange(1000), i) for i in range(400)] + [(1, None, 400), (None, 700, 401)]
    right = [(key(), rng.randrange(0, 1000, 7), rng.randrange(100), i) for i in range(60)] + [(2, None, 5, 5), (None, 600, 1, 2), (0, 500, 7, 7)]
    l, r = spark.createDataFrame(left, "k long, t long, i long"), spark.createDataFrame(right, "k long, t long, v long, w long")
    keys = ["k"] if keyed else []
    got = asof_join(l, r if keyed else r.drop("k"), "t", ["v", "w"], keys, n_chunks=16)
    assert got.columns == ["k", "t", "i", "v", "w"]
    assert sorted(str(tuple(x)) for x in got.collect()) == brute(left, right, keyed)


def test_empty_sides(spark):
    l = spark.createDataFrame([(1, 5)], "k long, t long")
    r = spark.createDataFrame([], "t long, v string")
    assert [tuple(x) for x in asof_join(l, r, "t", ["v"]).collect()] == [(1, 5, None)]
    assert asof_join(l.limit(0), r, "t", ["v"]).count() == 0


def test_nothing_is_windowed_whole(spark):
    """Windows over rows are cut by chunk; only the table of chunks is windowed by key."""
    import re

    l, r = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t")), spark.range(50).select((F.col("id") % 2).alias("k"), (F.col("id") * 20).alias("t"), F.col("id").alias("v"))
    df = asof_join(l, r, "t", ["v"], ["k"])
    text = df._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)
    assert len(windows) == 2 and sum("_chunk" in w for w in windows) == 1
    chunks = next(x for x in text.split("\n") if "Window [" in x and "_earlier" in x)
    assert "_last" in chunks  # the other one is over one row a key and chunk
