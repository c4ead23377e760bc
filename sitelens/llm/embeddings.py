"""Near-duplicate embeddings: spherical k-means assigns vectors to cells,
blocked cosine products compare within cells, one vector of a group is kept.

Equal vectors are one class with a number of members, found by one grouping that
is combined before its shuffle, so copies are compared once however many they are.
Centroids are fitted on a bounded sample of the classes (``SAMPLE`` vectors at most, chosen by
a hash of the id) and started from vectors that are not alike, so a large group of
near copies is one cell and not many equal ones; there is one cell for the square
root of the number of classes, ``CELLS`` at most.  Every vector belongs to the cell of its nearest
centroid and visits all cells whose centroid is nearly as near (cosine within
``MARGIN``); a cell compares its own vectors with each other and with its
visitors, and a pair that meets in two cells counts in the lower one.  All
vectors are indexed and compared; the margin decides which pairs of different
cells meet (recall against brute force is tested; see the README).

A cell is dealt into blocks of about ``BLOCK`` rows, and each pair of blocks is
a task of its own, so a hot cell is many tasks.  A task sends back a count for
each vector and one link to its smallest neighbour group, never the pairs.

Defined results: vectors that are null, zero or hold null or non-finite
components link with nothing, nor do vectors of different lengths; rows that
repeat an id are vectors of their own whose links are added up; a null id is
its own component (null) and is kept; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import components, joined_on_hot_key, mapped, materialize, maybe_among, ship, with_components

#: Cells and sampled vectors at most: what the driver holds and broadcasts.
CELLS, SAMPLE, ROUNDS = 4096, 1 << 16, 8
MARGIN = 0.1
BLOCK = 2048
#: Sampled vectors of this cosine do not both start a cell.
APART = 0.9


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]


def starts(sample: np.ndarray, cells: int) -> np.ndarray:
    """The first vectors of ``sample`` that are not alike (cosine under ``APART``
    with all that were chosen), ``cells`` at most; one at least."""
    chosen = sample[:1]
    for s in range(1, len(sample), 1024):
        if len(chosen) >= cells:
            break
        part = sample[s : s + 1024]
        part = part[(part @ chosen.T).max(1) < APART]
        alike = np.tril(part @ part.T >= APART, -1)
        chosen = np.concatenate([chosen, part[~alike.any(1)]])
    return chosen[:cells]


def centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: centroids of length one, ``cells`` at most."""
    at = starts(sample, cells).copy()
    for _ in range(rounds):
        near = np.concatenate([(part @ at.T).argmax(1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        total = np.zeros_like(at)
        np.add.at(total, near, sample)
        size = np.sqrt(np.einsum("ij,ij->i", total, total))
        at[size > 0] = total[size > 0] / size[size > 0, None]
    return at


def _assigned(classes: DataFrame, at: np.ndarray, dim: int) -> DataFrame:
    """``cell, home, visits`` and the columns of ``classes`` (the vector last): a
    row for the cell of each vector and each cell that it visits."""
    sent = classes.sparkSession.sparkContext.broadcast(at)  # CELLS rows at most
    names = ["cell", "home", "visits", *classes.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 1024):
                b = whole.slice(s, 1024)
                near = _unit(b.column(b.num_columns - 1), dim) @ sent.value.T
                home = near.argmax(1)
                row, cell = np.nonzero(near >= near.max(1, keepdims=True) - MARGIN)
                visits = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=b.num_rows))).astype(np.int32)), pa.array(cell.astype(np.int32)))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)), visits.take(take), *(c.take(take) for c in b.columns)], names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return mapped(classes, run, f"cell int, home int, visits array<int>, {kinds}")


def _linked(assigned: DataFrame, least: float, dim: int) -> DataFrame:
    """``class, links, vec, low``: the vectors of other classes that each task
    links a class with, its smallest id and the smallest id that the task's links lead to."""
    blocks = {r[0]: ceil(r[1] / BLOCK) for r in assigned.groupBy("cell").count().where(f"count > {BLOCK}").collect()}  # CELLS at most
    n = F.lit(1)
    if blocks:
        n = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("cell")), F.lit(1))
    dealt = assigned.withColumn("n", n.cast("int")).withColumn("block", F.pmod(F.xxhash64("class"), "n").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("n", "other")
    ship(assigned.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("vec", "ascending"), ("class", "ascending")])
        cell, i, j = (table.column(c)[0].as_py() for c in ("cell", "i", "j"))
        number, vec, many, home, block = (table.column(c).to_numpy() for c in ("class", "vec", "members", "home", "block"))
        unit = _unit(table.column("embedding").combine_chunks(), dim)
        visits = table.column("visits").combine_chunks()
        left, right = (np.flatnonzero(block == x) for x in (i, j))
        pairs = []
        for part in np.array_split(left, max(1, len(left) // 512)):
            a, b = np.nonzero(unit[part] @ unit[right].T >= least)
            pairs.append((part[a], right[b]))
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        keep = (a < b) if i == j else np.ones(len(a), bool)
        keep &= (home[a] == cell) | (home[b] == cell)
        a, b = a[keep], b[keep]
        # a pair of two cells that also meets in the other one counts in the lower
        met = np.ones(len(a), bool)
        two = np.flatnonzero(home[a] != home[b])
        own = np.where(home[a[two]] == cell, a[two], b[two])
        other = home[a[two] + b[two] - own].astype(np.int64)
        visited = np.repeat(np.arange(len(vec)), np.diff(visits.offsets.to_numpy())) * CELLS + visits.flatten().to_numpy()
        met[two] = (cell < other) | ~np.isin(own * CELLS + other, visited)
        links = np.zeros(len(vec), np.int64)
        np.add.at(links, a[met], many[b[met]])
        np.add.at(links, b[met], many[a[met]])
        low = np.arange(len(vec))
        while len(a):
            was = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            low = low[low]
            if (was == low).all():
                break
        some = np.flatnonzero((links > 0) | (low != np.arange(len(vec))))
        return pa.table({"class": pa.array(number[some]), "links": pa.array(links[some]), "vec": pa.array(vec[some]), "low": pa.array(vec[low[some]])})

    return dealt.groupBy("cell", "i", "j").applyInArrow(run, "class long, links long, vec long, low long")


def _classes(sound: DataFrame) -> DataFrame:
    """``dim, class, vec, members, embedding``: equal vectors once, under a number
    of their own, with their smallest id and how many rows they are."""
    same = sound.groupBy("dim", "embedding").agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("members"))
    return materialize(same.select("dim", F.monotonically_increasing_id().alias("class"), "vec", "members", "embedding"), "classes")[0]


def near_duplicates(table: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row; vectors of cosine ``least`` or more are linked."""
    spark = table.sparkSession
    given = table.select(F.col(id_col).cast("long").alias("vec"), F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = given.where("vec is not null and embedding is not null").where(finite & F.exists("embedding", lambda x: x != 0))
    # -0.0 is 0.0: vectors that differ by it only are equal
    zeros = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0)).otherwise(x)).cast(given.schema["embedding"].dataType)
    sound, n = materialize(sound.select("vec", zeros.alias("embedding")).withColumn("dim", F.size("embedding")), "vectors")
    classes = _classes(sound)
    found = spark.createDataFrame([], "class long, links long, vec long, low long")
    for dim, count in classes.groupBy("dim").count().orderBy("dim").collect():  # a handful of lengths
        one = classes.where(F.col("dim") == dim).drop("dim")
        cells = min(CELLS, ceil(sqrt(count)))
        sampled = one.withColumn("h", F.xxhash64("vec")).orderBy("h", "vec", F.xxhash64("embedding")).limit(min(SAMPLE, 64 * cells)).select("embedding").toArrow()
        at = centroids(_unit(sampled.column(0).combine_chunks(), dim), cells)
        assigned, _ = materialize(_assigned(one, at, dim), "assigned")
        found = found.unionByName(_linked(assigned, least, dim))
    found, _ = materialize(found, "links")
    # every row of a class is linked with the class's other rows and with those of the linked classes
    per = classes.join(found.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
    per = per.select("vec", "members", "embedding", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    per, _ = materialize(per.where("n_links > 0").withColumn("key_", F.xxhash64("embedding")), "class-links")
    copied = per.where("members > 1").select("key_", F.col("vec").alias("low"), F.col("embedding").alias("same_"), "n_links")
    rows_of = maybe_among(sound.withColumn("key_", F.xxhash64("embedding")), "key_", copied, "key_")
    rows_of, n_copies = materialize(rows_of.select("key_", "vec", "embedding"), "copies")
    copies, _ = materialize(joined_on_hot_key(rows_of, copied, "key_", n_copies).where("embedding = same_").select("vec", "low", "n_links"), "copy-links")
    counts = per.where("members = 1").select("vec", "n_links").unionByName(copies.select("vec", "n_links")).groupBy("vec").agg(F.sum("n_links").alias("n_links"))
    found = found.select("vec", "low").unionByName(copies.select("vec", "low"))
    rows, n_rows = materialize(given.select("vec"), "ids")
    out = with_components(rows, components(found, "vec", "low"), "vec", n_rows)
    out, _ = materialize(out, "labels")
    out = joined_on_hot_key(out, counts, "vec", n_rows, "left")
    return out.select(F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec").eqNullSafe(F.col("component_id")).alias("kept"))
