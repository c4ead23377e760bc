"""Chunked running sums and line slices."""

from __future__ import annotations

from pyspark.sql import functions as F

import model
from sitelens.operators import layout as lay
from sitelens.operators.prefix import running_sums


def test_running_sums_hot_key(spark):
    # key 0 holds most rows, so it spans many chunks
    rows = [(0 if i % 10 else 1 + i % 3, i // 7, i, (i * 37) % 11) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t long, id long, v long")
    out = running_sums(df, keys=["k"], order=["t", "id"], values={"s": F.col("v")},
                       firsts={"first_t": "t"}, n_chunks=16)
    got = {(r["k"], r["t"], r["id"], r["v"]): (r["s"], r["first_t"]) for r in out.collect()}
    exp = model.running(rows, key=lambda r: r[0], order=lambda r: (r[1], r[2]), value=lambda r: r[3])
    first = {}
    for r in rows:
        first[r[0]] = min(first.get(r[0], r[1]), r[1])
    assert got == {r: (exp[r], first[r[0]]) for r in rows}


def test_running_sums_no_key_and_filter(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 5 == 0).alias("keep"))
    out = running_sums(df, keys=[], order=["id"], values={"n": F.lit(1).cast("bigint")}, keep=F.col("keep"), n_chunks=7)
    got = sorted((r["id"], r["n"]) for r in out.collect())
    assert got == [(i, i + 1) for i in range(0, 500, 5)]


def test_line_slices_cover_and_overlap(spark):
    pages = spark.createDataFrame([("a", "".join(f"l{i}\n" for i in range(10))), ("b", "one"), ("c", "")], "path string, html string")
    got = sorted((r["path"], r["k"], r["line_no"], r["line"]) for r in lay.line_slices(pages, n_slices=4).collect())
    exp = [("a", k, i, f"l{i}") for k in range(4) for i in range(2 * k, min(2 * k + 3, 10))] + [("b", 0, 0, "one")]
    assert got == exp
    text = lay.line_slices(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
