"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct shingles of
``SHINGLE`` words (A-Z in lower case; a shorter text's whole word sequence is
its one shingle).  Equal sets are one class.  A class' sketch is its ``K``
smallest hashes.  Inverted lists of the retained values generate overlaps, the
sketch of the union estimates the similarity and filters, and the exact Jaccard
of the full sets verifies.

*Lists.*  Two similar sets share at least o of their retained values (o lies
five standard deviations under the threshold; for sets that a sketch holds in
full it is exact).  With values in order of frequency, the first k - o + 1 of
both then share one, so a class is listed under those alone: values that occur
once list nothing, and common passages come last.  A class with fewer than o
repeated values has no partner and leaves at once.
*Short lists* (``SHORT`` classes at most) pair their members.  *Long lists*
pair each member with ``LEADERS`` of its list, the most central ones; no group
is paired with itself.  Lists that share members make a cluster.  After the
links of these pairs are known, members outside their cluster's largest
component are compared with all members of the other components, block by
block on the full sets, so no link that could join two components is lost.

Defined results: a null or wordless text has an empty set and no link; repeated
rows of an id are one document, linked where any of their texts is; a null id
has no component and is kept; an empty table gives an empty result.  Columns
beyond the named ones are not read."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm import textbatch as tb
from sitelens.llm.common import clean, components, joined_on_hot_key, mapped, materialize, maybe_among, ship, spread, with_components

SHINGLE = 5
#: Values that a sketch retains.
K = 64
#: Standard deviations between the threshold and what the sketches must show.
SIGMAS = 5
SHORT, LEADERS = 32, 4
#: Sets of a block in the comparison of what the leaders left over.
BLOCK = 256


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each run of rows, every row's distinct shingle hashes in ascending order."""
    for _, data, offsets in tb.text_chunks(column):
        start, end, first = tb.word_spans(data, offsets)
        word = tb.exact_hash(tb.LOWER[data], start, end)
        n = max(0, len(word) - SHINGLE + 1)
        five = np.zeros(n, np.uint64)
        for j in range(SHINGLE):
            five += word[j : n + j] * tb.PLACE[20 + j]
        five = tb.mix(five).view(np.int64)
        out = []
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if j - i >= SHINGLE:
                one = np.sort(five[i : j - SHINGLE + 1])
                out.append(one[np.append(True, one[1:] != one[:-1])])
            else:
                out.append(tb.mix((word[i:j] * tb.PLACE[20 : 20 + j - i]).sum(keepdims=True)).view(np.int64)[: j > i])
        yield out


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_, n, d1, d2, sketch`` of every row: set size, set digest and the K smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for sets in shingle_sets(b.column(1)):
                sizes = np.array([len(s) for s in sets])
                flat = np.concatenate(sets).view(np.uint64)
                ends = np.cumsum(sizes)
                sums = [np.append(tb.U64(0), np.cumsum(x)) for x in (flat, tb.mix(flat * tb.PLACE[1]))]
                d1, d2 = (tb.mix(x[ends] - x[ends - sizes]) for x in sums)
                sketch = tb.long_lists(np.concatenate([s[:K] for s in sets]), np.minimum(sizes, K))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(sets)), pa.array(sizes), tb.as_longs(d1), tb.as_longs(d2), sketch], ["id_", "n", "d1", "d2", "sketch"])
                at += len(sets)

    given = spread(docs).select(F.col(id_col).cast("long").alias("id_"), F.col(text_col).alias("text_"))
    return mapped(given, run, "id_ long, n long, d1 long, d2 long, sketch array<long>")


def _full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, full``: the sets of the documents whose id is in ``ids`` (and of few others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for sets in shingle_sets(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(sets)), tb.long_lists(np.concatenate(sets), np.array([len(s) for s in sets]))], ["rep", "full"])
                at += len(sets)

    given = maybe_among(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text_")), "rep", ids, "rep")
    return mapped(given, run, "rep long, full array<long>")


def _least_shared(percent: int) -> list[int]:
    """By the number k of retained values (index): how many of them a partner has, at least."""
    t = percent / 100
    return [0] + [ceil(t * k) if k <= t * K else max(1, floor((t - SIGMAS * sqrt(t * (1 - t) / k)) * k)) for k in range(1, K + 1)]


def _near(a: Column | str, b: Column | str, percent: int) -> Column:
    """Set sizes that allow the similarity."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Pairs ``a, b`` of short lists and of long lists' members with leaders, and how many there are of each."""
    least = F.array(*map(F.lit, _least_shared(percent)))
    entries = classes.select("rep", F.explode("sketch").alias("v"))
    common = entries.groupBy("v").count().where("count > 1").withColumnRenamed("count", "df")
    own = (entries.join(common, "v").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))
           .join(classes.select("rep", "n", F.size("sketch").alias("k")), "rep")
           .withColumn("prefix", F.size("vs") - F.element_at(least, F.col("k") + 1) + 1).where("prefix > 0")
           .withColumn("central", F.aggregate("vs", F.lit(0).cast("long"), lambda s, x: s + x["df"])))
    listed, n_listed = materialize(own.select("rep", "n", "central", F.explode(F.slice("vs", 1, F.col("prefix")))
                                              .alias("x")).select("rep", "n", "central", F.col("x.v").alias("v")), "lists")
    quarter = F.pmod(F.xxhash64("rep"), F.lit(LEADERS))
    head = F.struct("central", "rep", "n")
    heads, _ = materialize(listed.groupBy("v").agg(F.count(F.lit(1)).alias("size"), F.array_compact(F.array(
        *[F.max(F.when(quarter == i, head)) for i in range(LEADERS)])).alias("leaders")).where("size > 1"), "heads")
    short = listed.join(heads.where(f"size <= {SHORT}").select("v"), "v")
    a, b = short.select("v", F.col("rep").alias("a"), F.col("n").alias("n_a")), short.select("v", F.col("rep").alias("b"), F.col("n").alias("n_b"))
    pairs = a.join(b, "v").where((F.col("a") < F.col("b")) & _near("n_a", "n_b", percent)).select("a", "b").distinct()
    long_lists = heads.where(f"size > {SHORT}").select("v", F.transform("leaders", lambda x: F.struct(x["rep"].alias("b"), x["n"].alias("n"))).alias("leaders"))
    met = joined_on_hot_key(listed.select("rep", "n", "v"), long_lists, "v", n_listed)
    stars = (met.groupBy("rep", "n").agg(F.array_distinct(F.flatten(F.collect_set("leaders"))).alias("leaders"))
             .select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.explode("leaders").alias("x"))
             .where((F.col("a") != F.col("x.b"))).select("a", F.col("x.b").alias("b"), _near("n_a", "x.n", percent).alias("fits")))
    pairs, n_pairs = materialize(pairs, "pairs")
    stars, n_stars = materialize(stars, "stars")
    clean(classes.sparkSession)
    return pairs, stars, n_pairs, n_stars


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()


def _joined_twice(pairs: DataFrame, right: DataFrame, cols: list[str], total: int) -> DataFrame:
    """``a, b`` pairs with the columns of both ends, as ``<col>_a`` and ``<col>_b``."""
    for end in ("a", "b"):
        pairs = joined_on_hot_key(pairs, right.select(F.col("rep").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in cols]), end, total)
    return pairs


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n_pairs: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Those pairs that the union's sketch lets through and the full sets confirm."""
    t = percent / 100
    classes = maybe_among(classes, "rep", _ends(pairs), "rep")
    both = _joined_twice(pairs, classes, ["sketch"], n_pairs)
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, K)
    shown = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b"))) / F.size(union)
    passed, n = materialize(both.where(shown >= t - SIGMAS * sqrt(t * (1 - t) / K)).select("a", "b"), "estimated")
    if not n:
        return passed
    sets = _full_sets(docs, _ends(passed), id_col, text_col)
    shared = F.size(F.array_intersect("full_a", "full_b"))
    linked = 100 * shared >= percent * (F.size("full_a") + F.size("full_b") - shared)
    return _joined_twice(passed, sets, ["full"], n).where(linked).select("a", "b")


def _left_over(docs: DataFrame, stars: DataFrame, edges: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links between components of one cluster of long lists that its leaders did not show."""
    members = components(stars, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    members, n = materialize(members, "members")
    members, _ = materialize(with_components(members, components(edges, "a", "b"), "rep", n, "label"), "labels")
    sizes = members.groupBy("cluster", "label").count().groupBy("cluster").agg(
        F.max(F.struct("count", "label")).getField("label").alias("main"), F.sum("count").alias("all"), F.max("count").alias("most")).where("all > most")
    open_, n_open = materialize(joined_on_hot_key(members, sizes, "cluster", n), "open")
    if not n_open:
        return edges.limit(0)
    sets = _full_sets(docs, open_.select("rep").distinct(), id_col, text_col)
    rows = open_.join(sets, "rep")
    deal = lambda n: F.pmod(F.xxhash64("rep"), F.greatest(F.ceil(n / BLOCK), F.lit(1))).cast("int")
    m_blocks, u_blocks = F.ceil(F.col("all") / BLOCK).cast("int"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int")
    every = rows.withColumn("m", deal(F.col("all"))).withColumn("u", F.explode(F.sequence(F.lit(0), u_blocks - 1))).withColumn("asks", F.lit(False))
    rest = (rows.where("label <> main").withColumn("u", deal(F.col("all") - F.col("most")))
            .withColumn("m", F.explode(F.sequence(F.lit(0), m_blocks - 1))).withColumn("asks", F.lit(True)))
    ship(docs.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        rep, label, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "label", "asks"))
        full = table.column("full").combine_chunks()
        size = np.diff(full.offsets.to_numpy())
        _, value = np.unique(full.values.to_numpy()[full.offsets[0].as_py() :], return_inverse=True)
        row = np.repeat(np.arange(len(rep)), size)
        cut = np.append(0, np.cumsum(size))
        flag, out = np.zeros(len(value) + 1, bool), set()
        for i in np.flatnonzero(asks):
            mine = value[cut[i] : cut[i + 1]]
            flag[mine] = True
            shared = np.bincount(row[flag[value]], minlength=len(rep))
            flag[mine] = False
            hit = (100 * shared >= percent * (size[i] + size - shared)) & ~asks & (label != label[i]) & (size[i] > 0)
            if hit.any():  # one link to each other component joins as well as all
                _, one = np.unique(label[hit], return_index=True)
                out.update((int(rep[i]), int(x)) for x in rep[hit][one])
        found = sorted(out)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    keep = ["cluster", "u", "m", "rep", "label", "asks", "full"]
    return every.select(keep).unionByName(rest.select(keep)).groupBy("cluster", "u", "m").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row; two documents
    are linked when their sets' Jaccard similarity is ``percent`` hundredths or more."""
    if docs.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer")
    rows, n_rows = materialize(sketches(docs, id_col, text_col), "sketches")
    classes = rows.where("n > 0 and id_ is not null").groupBy("d1", "d2").agg(F.min("id_").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes, _ = materialize(classes, "classes")
    pairs, stars, n_pairs, n_stars = _candidates(classes, percent)
    tried = pairs.union(stars.where("fits").select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    edges, n_edges = materialize(_verified(docs, classes, tried, n_pairs + n_stars, percent, id_col, text_col), "edges")
    clean(docs.sparkSession)
    if n_stars:
        more, n_more = materialize(_left_over(docs, stars, edges, percent, id_col, text_col), "more")
        clean(docs.sparkSession)
        if n_more:
            edges, n_edges = edges.union(more), n_edges + n_more
    by_class = with_components(classes.select("d1", "d2", "rep"), components(edges, "a", "b"), "rep", n_rows)
    by_class, _ = materialize(by_class.select("d1", F.col("d2").alias("e2"), "component_id"), "byclass")
    linked = rows.select("id_", "n", "d1", "d2").where("n > 0 and id_ is not null")
    linked = joined_on_hot_key(linked, by_class, "d1", n_rows).where("d2 = e2").select("id_", "n", "component_id")
    alone = rows.where("n = 0 or id_ is null").select("id_", "n", F.col("id_").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id_").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                            F.col("id_").eqNullSafe(F.col("component_id")).alias("kept"))
