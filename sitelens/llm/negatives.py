"""Hard negatives by lists that the members of an anchor cluster share.

A row's score for an anchor is their integer inner product.  An anchor's
positives are its best other rows of its label; for each of them the hard
negatives are the best rows of other labels whose score lies between a share of
the positive's score and that score.

Anchors of a task are clustered by direction (spherical k-means).  For a cluster
with centroid c, whose members lie within an angle b of it, a candidate v has
the upper bound |v| cos(max(0, angle(v, c) - b)) on its product with every
member of length one.  The candidates are sorted by it once, and every member
walks that list until the bound of what is left, times its own length, is below
the score that it still needs: its fifth best, the seed that other anchors give,
or the least score of its windows.  So the result is exact.

Rows are dealt by a hash of their number into blocks that grow with the square
root of the table (``LEAST_BLOCK`` to ``MOST_BLOCK`` rows) and anchors into groups
of ``ANCHORS``; a task has a group and a block.  It returns at most ``keep`` rows an
anchor or window, which a window with a limit by group brings together.

Defined results: rows with a null id, label or vector, with a null or non-finite
component, or whose components (scaled) have a squared sum of 2**62 or more, so
that scores may not fit a long, take no part.  Vectors of different lengths are
not compared.  Rows that repeat an id are rows of their own, as candidates and
as anchors; only the anchor's own row is not its other.  Ties go to the smaller
id.  An anchor without positives, and a positive without rows in its window, give
no row; an empty table gives an empty result; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import materialize, ship

#: Anchors of a task at most, on average.
ANCHORS = 1 << 14
#: Rows of a block: 16 for each row of the square root of the table, within these.
LEAST_BLOCK, MOST_BLOCK = 1 << 10, 1 << 16
#: Members of an anchor cluster, about, and rounds of its k-means.
MEMBERS, ROUNDS = 128, 4
#: First and longest part of a list that members walk at once.
FIRST, PART = 64, 4096
#: Anchors of a label that give its others a first bound.
SEEDS = 512
#: Room for the rounding of angles and lengths.
ANGLE, SLACK = 1e-6, 1 + 1e-6
_NONE = np.iinfo(np.int64).min


def _matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    column = column.combine_chunks()
    dim = len(column[0])
    return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(column), dim)


def _length(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _unit(x: np.ndarray) -> np.ndarray:
    n = _length(x)[:, None]
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products: in doubles where no sum can leave their integers, else in longs."""
    if _length(a).max(initial=0) * _length(b).max(initial=0) * SLACK < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def clusters(unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """``members, centroid, angle`` of a spherical k-means that starts from evenly chosen vectors."""
    k = max(1, len(unit) // MEMBERS)
    at = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        near = (unit @ at.T).argmax(1)
        total = np.zeros_like(at)
        np.add.at(total, near, unit)
        at = np.where(_length(total)[:, None] > 0, _unit(total), at)
    near = (unit @ at.T).argmax(1)
    for c in np.unique(near):
        members = np.flatnonzero(near == c)
        cos = np.clip(unit[members] @ at[c], -1, 1)
        yield members, at[c], float(np.arccos(cos).max()) + ANGLE


def shared_list(vectors: np.ndarray, unit: np.ndarray, centroid: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """``order, bound``: candidates by falling upper bound on their product with any unit vector within ``angle`` of the centroid."""
    apart = np.maximum(0, np.arccos(np.clip(unit @ centroid, -1, 1)) - angle)
    bound = _length(vectors) * np.cos(apart) * SLACK + ANGLE
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def _best(slot: np.ndarray, score: np.ndarray, who: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first ``keep`` entries of each slot, by falling score and rising id, and their ranks."""
    order = np.lexsort((who, -score, slot))
    slot, score, who = slot[order], score[order], who[order]
    start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, int)
    rank = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
    some = rank < keep
    return slot[some], score[some], who[some], rank[some]


def walk(anchors: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, rows: np.ndarray, ids: np.ndarray, order: np.ndarray, bound: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``slot, score, id`` of the best ``keep`` rows of each window of each member.

    ``low`` and ``high`` are (members, windows) of scores; slots number them in
    rows.  ``allowed(members, rows)`` says which rows may count for which member.
    A member leaves when the bound of the next row is below all that it needs."""
    m, windows = low.shape
    need, size = low.copy(), _length(anchors)
    got = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    here, at, step = np.arange(m), 0, FIRST
    while at < len(order):
        least = need[here].min(axis=1)
        there = size[here] * bound[at] + ANGLE >= least
        here, least = here[there], least[there]
        if not len(here):
            break
        part = order[at : at + step]
        score = _scores(anchors[here], rows[part])
        found = (score >= least[:, None]) & (score <= high[here].max(axis=1)[:, None]) & allowed(here, part)
        a, b = np.nonzero(found)
        if len(a):
            value, who, member = score[a, b], ids[part[b]], here[a]
            new = [[got[0]], [got[1]], [got[2]]]
            for w in range(windows):
                fits = (value >= need[member, w]) & (value <= high[member, w])
                for held, x in zip(new, (member[fits] * windows + w, value[fits], who[fits]), strict=True):
                    held.append(x)
            slot, value, who, rank = _best(*map(np.concatenate, new), keep)
            got = slot, value, who
            full = rank == keep - 1
            need.ravel()[slot[full]] = np.maximum(need.ravel()[slot[full]], value[full])
        at += len(part)
        step = min(PART, 2 * step)
    return got


def _sides(mine: pa.Table, block: pa.Table, scale: float) -> tuple:
    a, v = _matrix(mine.column("embedding"), scale), _matrix(block.column("embedding"), scale)
    return (a, v, *(t.column(c).to_numpy() for t in (mine, block) for c in ("row", "label")), block.column("vec_id").to_numpy())


def _positives(mine: pa.Table, block: pa.Table, scale: float, keep: int) -> pa.Table:
    """Each anchor's best rows of its label in a block, without those that cannot be among its best."""
    a, v, row, label, other, kind, ids = _sides(mine, block, scale)
    unit = _unit(v)
    out = []
    for one in np.unique(label):
        own, same = np.flatnonzero(label == one), np.flatnonzero(kind == one)
        if not len(same):
            continue
        seeds = own[:SEEDS]
        first = _scores(a[own], a[seeds])
        first[row[own][:, None] == row[seeds]] = _NONE
        least = np.sort(first, axis=1)[:, -keep] if len(seeds) >= keep else np.full(len(own), _NONE)
        for members, centroid, angle in clusters(_unit(a[own])):
            who = own[members]
            order, bound = shared_list(v[same], unit[same], centroid, angle)
            slot, score, got = walk(a[who], least[members][:, None], np.full((len(who), 1), np.iinfo(np.int64).max), keep, v[same], ids[same], order, bound,
                                    lambda here, part, who=who, same=same: row[who[here]][:, None] != other[same[part]])
            out.append((row[who[slot]], score, got))
    cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("row", "score", "who"), cols, strict=True)))


def _negatives(mine: pa.Table, block: pa.Table, scale: float, keep: int, least: int) -> pa.Table:
    """For each of the anchors' positive scores, its best rows of other labels in a block."""
    a, v, row, label, other, kind, ids = _sides(mine, block, scale)
    unit, given = _unit(v), mine.column("scores").combine_chunks()
    n = np.diff(given.offsets.to_numpy())
    high = np.full((len(a), int(n.max(initial=1))), _NONE)
    high[np.arange(high.shape[1]) < n[:, None]] = given.flatten().to_numpy()
    low = np.full(high.shape, np.iinfo(np.int64).max)  # no score fits where there is no window
    some = high >= 0  # a share of a negative score is above it
    low[some] = _share(high[some], least)
    out = []
    for members, centroid, angle in clusters(_unit(a)):
        order, bound = shared_list(v, unit, centroid, angle)
        slot, score, got = walk(a[members], low[members], high[members], keep, v, ids, order, bound, lambda here, part, members=members: label[members[here]][:, None] != kind[part])
        member, w = members[slot // high.shape[1]], slot % high.shape[1]
        out.append((row[member], high[member, w], score, got))
    cols = [np.concatenate(x) for x in zip(*out, strict=True)]
    return pa.table(dict(zip(("row", "positive_score", "score", "who"), cols, strict=True)))


def _share(score: np.ndarray, least: int) -> np.ndarray:
    """The smallest integer n with least * score <= 100 * n, without leaving the longs."""
    whole, rest = np.divmod(score, 100)
    return whole * least - (-rest * least) // 100


def mined(table: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, scale: float = 256,
          id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` says which rows of ``table`` are anchors; components are scaled by
    ``scale`` and rounded down; a negative has ``least`` hundredths of the
    positive's score at least and that score at most."""
    spark = table.sparkSession
    given = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("embedding"), anchor.alias("is_anchor"))
    given = given.where("vec_id is not null and label is not null and embedding is not null")
    squares = F.aggregate("embedding", F.lit(0.0), lambda n, x: n + F.pow(scale * x.cast("double"), F.lit(2.0)))
    given = given.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x))).where(squares < float(2**62))
    rows, n = materialize(given.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "rows")
    n_anchors = rows.where("is_anchor").count()
    groups, blocks = max(1, ceil(n_anchors / ANCHORS)), max(1, ceil(n / min(MOST_BLOCK, max(LEAST_BLOCK, int(16 * sqrt(n))))))
    keys = ["dim", "group", "block"]

    def dealt(df: DataFrame, own: str, own_n: int, every: str, every_n: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(own_n)))
        return df.withColumn(every, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(every_n - 1).cast("long"))))

    ship(spark)
    kept = ["row", "vec_id", "label", "embedding", "dim"]

    def met(anchors: DataFrame, run, schema: str) -> DataFrame:
        every = dealt(rows.select(*[F.col(c).alias(c) for c in kept]), "block", blocks, "group", groups)
        return dealt(anchors, "group", groups, "block", blocks).groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(run, schema)

    def some(run, schema: pa.Schema):
        return lambda mine, block: run(mine, block) if mine.num_rows and block.num_rows else schema.empty_table()

    anchors = rows.where("is_anchor").select(*kept)
    long = [("row", pa.int64()), ("score", pa.int64()), ("who", pa.int64())]
    found = met(anchors, some(lambda m, b: _positives(m, b, scale, positives), pa.schema(long)), "row long, score long, who long")
    best, _ = materialize(_first(found, ["row"], positives), "positives")
    scores = best.groupBy("row").agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most ``positives`` an anchor
    with_scores, _ = materialize(anchors.join(scores, "row"), "anchors")
    schema = pa.schema([long[0], ("positive_score", pa.int64()), *long[1:]])
    found = met(with_scores, some(lambda m, b: _negatives(m, b, scale, negatives, least), schema), "row long, positive_score long, score long, who long")
    hard, _ = materialize(_first(found, ["row", "positive_score"], negatives), "negatives")
    hard = hard.select("row", "positive_score", F.col("rank").cast("int").alias("rank"), F.col("who").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select("row", F.col("score").alias("positive_score"), F.col("who").alias("positive_id")).join(with_scores.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return pairs.join(hard, ["row", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _first(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The first ``keep`` rows of a key, by falling score and rising id; Spark limits each task's groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "who"))
    return found.withColumn("rank", rank).where(F.col("rank") <= keep)


#: DuckDB SQL of the query: the plain definition.
SQL = """
WITH g AS (SELECT vec_id, CAST(label AS BIGINT) AS l0, embedding FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (l0 + 1) % 10 ELSE l0 END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM g),
s AS (SELECT a.rid, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.rid <> b.rid AND len(a.v) = len(b.v)),
p AS (SELECT rid, anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.rid, p.positive_id ORDER BY s.score DESC, s.other_id) AS rk
      FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rk AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rk <= 5
"""
