"""Hard negatives against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import negatives


def brute(rows, anchor):
    """``rows`` of (id, vector, label) in place order; ties of equal ids are interchangeable."""
    rows = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, label) in enumerate(rows):
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, own == label) for m, (j, w, own) in enumerate(rows) if m != k and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2]][:5]:
            fits = [x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, rank, other, -s, -t) for rank, (t, other, _) in enumerate(fits, 1)]
    return sorted(out)


def _check(spark, rows, every=10):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("row", "dim", "group", "block", "score", "who", "rank")})
    got = sorted(map(tuple, negatives.mined(table, anchor=F.col("vec_id") % every == 0).collect()))
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()], lambda i: i % every == 0)
    return got


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_against_all_products(spark, monkeypatch, spread):
    """Directions in tight and wide groups, a hot label, several blocks and groups, walks of many parts."""
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 100)
    monkeypatch.setattr(negatives, "MOST_BLOCK", 100)
    monkeypatch.setattr(negatives, "ANCHORS", 17)
    monkeypatch.setattr(negatives, "MEMBERS", 4)
    monkeypatch.setattr(negatives, "FIRST", 2)
    rng = np.random.default_rng(int(spread * 100))
    base = rng.normal(size=(6, 8))
    x = base[rng.integers(0, 6, 400)] + spread * rng.normal(size=(400, 8))
    label = np.where(rng.random(400) < 0.4, 0, rng.integers(0, 6, 400))
    assert _check(spark, [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label, strict=True))])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (3, [0.9, 0.1], 2), (4, [0.9, 0.1], 2), (5, [0.0, 0.0], 2), (10, [0.0, 0.0], 1),
            (11, None, 1), (12, [1.0, None], 1), (13, [1.0, nan], 1), (14, [1.0, inf], 2), (15, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (16, [1.0], 2), (20, [-1.0, 0.0], 3),
            (21, [-1.0, 0.0], 3), (30, [], 1), (31, [], 1), (32, [], 2), (17, [1e6, -1e6], 2), (18, [1e6, 1e6], 1), (40, [1e6, 1e6], 1)]
    _check(spark, rows)
    assert negatives.mined(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), anchor=F.col("vec_id") % 2 == 0).count() == 0


def test_sql_and_query_agree(spark, small_dir):
    import duckdb

    from sitelens.llm.queries import op13_negatives

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small_dir}/embeddings.parquet'")
    assert sorted(map(tuple, op13_negatives(spark, small_dir).collect())) == sorted(con.sql(negatives.SQL).fetchall())


def test_bounds_hold(spark):
    rng = np.random.default_rng(4)
    a, v = rng.normal(size=(300, 6)), rng.normal(size=(500, 6)) * rng.random((500, 1)) * 9
    for members, centroid, angle in negatives.clusters(negatives._unit(a)):
        order, bound = negatives.shared_list(v, negatives._unit(v), centroid, angle)
        assert (np.diff(bound) <= 0).all()
        assert (negatives._unit(a[members]) @ v[order].T <= bound).all()
