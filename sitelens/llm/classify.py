"""What the two linear classifiers share: the labelled sample, the fit in one
task on the features of that bounded sample (made by the tasks that read its
texts), and scoring of every row by sparse dot products."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import mapped, materialize, spread

#: At most so many labelled rows are used to fit, chosen by a hash of the id, and of
#: these the first whose texts have at most so many bytes in all (at least one).
MAX_LABELLED, MAX_BYTES = 16_000, 256 << 20


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, id_col: str, text_col: str, bound: int) -> DataFrame:
    """``rank, text, label`` of at most ``bound`` labelled rows and ``MAX_BYTES``
    bytes, as a written table joined with the ids that fit: it may be read again.
    They are the first by a hash of the id among those that ``keep`` allows.  A
    label that is null is none; of several labels of an id the largest counts, of
    several rows of an id the text with the smallest hash.  The chosen labels
    (``bound`` short rows at most) are broadcast, so texts are read in place, and
    rows of an id are reduced to one by each task."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
              .where(F.col("label").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
              .where(keep).withColumn("rank", F.xxhash64("id")).orderBy("rank", "id").limit(bound))
    met = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    one = met.groupBy("rank", "id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one, _ = materialize(one, "sample")
    before = Window.orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, -1)  # over ``bound`` short rows
    used = one.select("rank", "id", F.octet_length("text").alias("size")).withColumn("used", F.sum("size").over(before))
    fits = used.where(F.coalesce("used", F.lit(0)) + F.coalesce("size", F.lit(0)) <= MAX_BYTES).select("id")
    first = used.orderBy("rank", "id").select("id").limit(1)
    ids, _ = materialize(fits.union(first).distinct(), "fits")
    return one.join(F.broadcast(ids), "id", "left_semi")


def featured(sample: DataFrame, features: Callable[[pa.Array], Iterator[list[pa.Array]]], names: dict[str, str]) -> DataFrame:
    """``rank, id, label`` of the sample and the columns (names with their types)
    that ``features(texts)`` yields, run by run of rows in order: every task
    sends features of the texts that it reads, no text goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for made in features(b.column("text")):
                part = b.slice(at, len(made[0]))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], ["rank", "id", "label", *names])
                at += len(made[0])

    given = sample.select("rank", "id", "label", "text")
    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields[:3]} | names
    return mapped(given, run, ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


def _lists(batches: list[pa.RecordBatch], name: str) -> Iterator[np.ndarray]:
    """Each row's numbers of a list column, as views of the batches."""
    for b in batches:
        column = b.column(name)
        cut, flat = column.offsets.to_numpy(), column.values.to_numpy()
        yield from (flat[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True))


def fitted(rows: DataFrame, size: int, values: np.ndarray | None = None, **how: float) -> tuple[np.ndarray, float]:
    """Weights of ``size`` places and intercept by :func:`ftrl` (``how``), run in
    one task on ``rank, id, label, at`` and ``value`` of the bounded sample, without
    ``value`` where a place has the same in all rows, by ``values``.  The task holds
    4 or 8 bytes a feature and no text.  Only non-zero weights come back."""
    sent = None if values is None else rows.sparkSession.sparkContext.broadcast(values)
    names = ["at"] if sent else ["at", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        y = np.concatenate([b.column("label").to_numpy(zero_copy_only=False) for b in got]) if got else np.zeros(0)
        read = list(zip(*(_lists(got, n) for n in names), strict=True))
        weights, bias = ftrl(read, y.astype(np.float64), size, values=sent.value if sent else None, **how)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(weights[at], bias).astype(np.float64))], ["at", "weight"])

    ordered = rows.repartition(1).sortWithinPartitions("rank", "id").select("label", *names)
    weights, bias = np.zeros(size), 0.0
    for at, weight in mapped(ordered, run, "at int, weight double").collect():
        if at < 0:
            bias = weight
        else:
            weights[at] = weight
    return weights, bias


def scored(docs: DataFrame, carried: dict[str, Column], text_col: str, model: tuple[np.ndarray, float],
           margins: Callable[[pa.Array, np.ndarray], np.ndarray]) -> DataFrame:
    """The carried columns and ``score``, the logistic function of the margin,
    for every row.  A text that is carried under its own name is sent once."""
    weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # as many values as places

    names = list(carried)
    at = names.index(text_col) if text_col in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin = margins(b.column(at), sent.value) + bias
            score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(score)], [*names, "score"])

    given = spread(docs).select(*[c.alias(n) for n, c in carried.items()], *[F.col(text_col).alias("text_")][: at == len(names)])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[: len(names)]], "score double"])
    return mapped(given, run, schema)


def ftrl(rows: list[tuple[np.ndarray, ...]], y: np.ndarray, size: int, epochs: int, alpha: float, beta: float,
         l1: float, l2: float, values: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Follow-the-regularised-leader (proximal) logistic regression.

    Each row is ``(places, values)`` with distinct places, or places alone where
    ``values`` has each place's value; rows are read once an epoch and not
    copied.  Per coordinate z is the sum of gradients less the learning-rate
    change times the weight and n the sum of squared gradients; a weight is 0
    while |z| <= l1."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    last, one = np.array([size], np.int32), np.ones(1, np.float32)  # the last place: the intercept

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(z[at]) <= l1] = 0
        return w

    for _ in range(epochs):
        for row, label in zip(rows, y, strict=True):
            value = np.concatenate([row[1] if values is None else values[row[0]], one]).astype(np.float32)
            at = np.concatenate([row[0], last])
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - label) * value
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w, moved = np.zeros(size + 1), np.flatnonzero(np.abs(z) > l1)
    w[moved] = weights(moved)
    return w[:size], float(w[size])
