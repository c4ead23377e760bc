"""Near duplicates (documents and vectors) and connected components."""

import numpy as np
import pytest
from brute import closure, near_duplicates

from sitelens.llm import common, embeddings, minhash

WORDS = [f"w{i}" for i in range(400)]


def _text(rng, n):
    return " ".join(rng.choice(WORDS, n))


def _edited(rng, text, edits):
    words = text.split()
    for at in rng.integers(0, len(words), edits):
        words[at] = f"e{rng.integers(1 << 30)}"
    return " ".join(words)


def _check(docs, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, percent).collect()}
    want = near_duplicates([(r.doc_id, r.text) for r in docs.collect()], percent)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == closure(linked, [(a, b) for a, b in links if a != b])
    assert common.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_hot_key_join_is_an_equi_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 7)], "k long, x int")
    right = spark.createDataFrame([(i, -i) for i in range(0, 300, 2)] + [(1, 1)], "k long, y int")
    assert common.hot_keys(left, "k", 300)
    for how in ("inner", "left"):
        assert sorted(map(str, common.joined_on_hot_key(left, right, "k", 300, how).collect())) == sorted(map(str, left.join(right, "k", how).collect()))
    keys = left.select("k")
    assert sorted(map(str, common.joined_on_hot_key(keys, right, "k", 300).collect())) == sorted(map(str, keys.join(right, "k").collect()))


def test_near_duplicates_of_the_small_table(small_documents):
    _check(small_documents, 85)


def test_long_lists_lose_no_link(documents, monkeypatch):
    """Large groups of copies with edits, around both thresholds, by leaders and left-over comparison."""
    monkeypatch.setattr(minhash, "SHORT", 4)
    monkeypatch.setattr(minhash, "LEADERS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows, passage = [], _text(rng, 40)
    for group in range(3):
        base = _text(rng, 60 + 60 * group)
        rows += [_edited(rng, base, int(e)) for e in rng.integers(0, 5 + 2 * group, 60)]
    rows += [passage + " " + _text(rng, 50) for _ in range(30)]  # a common passage alone links nothing
    order = rng.permutation(len(rows))
    _check(documents([(int(i), rows[int(i)]) for i in order]), 80)


def test_near_duplicates_of_odd_rows(documents):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(9, None), (8, ""), (7, " \n\t"), (6, "one two"), (5, "ONE  two"), (4, "Ä b c d e f"), (3, "ä b c d e f"), (2, long), (1, long + " y")]
    docs = documents(rows)
    _check(docs, 85)
    again = minhash.near_duplicates(docs.union(docs), 85)
    assert sorted(map(tuple, again.collect())) == sorted(2 * [tuple(r) for r in minhash.near_duplicates(docs, 85).collect()])
    assert minhash.near_duplicates(documents([])).count() == 0
    none = minhash.near_duplicates(documents([(None, "a b c d e f"), (1, "a b c d e f")]), 85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in none) == [(0, 0, True), (1, 1, True)]


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell int, vec long").drop("none")


def test_embeddings_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(60, 16))
    hot = base[:1] + 0.04 * rng.normal(size=(150, 16))  # one cell, several blocks
    near = base[rng.integers(0, 60, 200)] + 0.06 * rng.normal(size=(200, 16))
    x = np.concatenate([base, hot, near]).astype(np.float32)
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 15 + [None]), (9003, [float("nan")] * 16), (9004, [float("inf")] + [1.0] * 15), (9005, [1.0, 2.0]), (9006, [2.0, 4.0]), (9007, [])]
    table = _vectors(spark, [(i, v.tolist(), 0, 1, 2) for i, v in enumerate(x)] + [(i, v, 0, 1, 2) for i, v in odd])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    found, there = sum(got[i][0] for i in range(len(x))), int(linked.sum())
    assert 0.99 * there <= found <= there and there > 10_000
    assert all(got[i][0] <= linked[i].sum() for i in range(len(x)))
    assert got[9005] == (1, 9005, True) and got[9006] == (1, 9005, False)
    assert all(got[i] == (0, i, True) for i in (9000, 9001, 9002, 9003, 9004, 9007))
    of = closure(range(len(x)), zip(*(v.tolist() for v in np.nonzero(linked)), strict=True))
    assert np.mean([got[i][1] == of[i] for i in range(len(x))]) > 0.99


def test_copies_are_compared_once(spark, monkeypatch):
    """A third of the rows are one vector, another third are near copies of a
    second one: neither makes further cells, visits or comparisons."""
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(200, 16))
    near = base[1] + 0.01 * rng.normal(size=(200, 16))
    x = np.concatenate([base, np.repeat(base[:1], 200, 0), near]).astype(np.float32)
    x[5, 0], x[6] = 0.0, x[5]
    x[6, 0] = -0.0  # equal to row 5
    ids = list(range(len(x)))
    ids[250] = 3  # a copy under another vector's id
    assigned = []
    whole = embeddings._assigned

    def counted(classes, at, dim):
        out = whole(classes, at, dim)
        assigned.append((classes.count(), out.count(), len(at)))
        return out

    monkeypatch.setattr(embeddings, "_assigned", counted)
    table = _vectors(spark, [(i, v.tolist(), 0, 1, 2) for i, v in zip(ids, x, strict=True)])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = y @ y.T >= 0.95
    np.fill_diagonal(linked, False)
    want: dict = {}
    for i, n in zip(ids, linked.sum(1), strict=True):
        want[i] = want.get(i, 0) + int(n)
    of = closure(set(ids), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)])
    assert got == {i: (want[i], of[i], i == of[i]) for i in want}
    classes, rows, cells = assigned[0]
    assert classes == len(x) - 201 and rows < 3 * classes and cells <= 20


def test_starts_are_not_alike():
    rng = np.random.default_rng(1)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 3000, 0), rng.normal(size=(500, 8))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    at = embeddings.starts(rng.permutation(x), 40)
    alike = at @ at.T
    np.fill_diagonal(alike, 0)
    assert len(at) == 40 and alike.max() < embeddings.APART
    assert len(embeddings.starts(x[:3000], 40)) == 1


def test_embeddings_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rng = np.random.default_rng(2)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    # copies at cosines around 0.97 beside the given vectors, which are all apart
    rows += [(10_000 + i, (np.array(v) + 0.25 * rng.normal(size=len(v)) / np.sqrt(len(v))).tolist()) for i, v in rows[:1000]]
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(_vectors(spark, [(i, v, 0, 0, 0) for i, v in rows])).collect()}
    x = np.array([np.float32(v) for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    there = int((x @ x.T >= 0.95).sum() - len(x))
    assert there > 1500 and sum(got.values()) >= 0.95 * there


def test_no_vectors(spark):
    assert embeddings.near_duplicates(_vectors(spark, [])).count() == 0
    same = embeddings.near_duplicates(_vectors(spark, [(None, [1.0, 0.0], 0, 0, 0), (3, [1.0, 0.0], 0, 0, 0), (3, [1.0, 0.0], 0, 0, 0)])).collect()
    assert sorted((r.vec_id or 0, r.component_id or 0, r.kept) for r in same) == [(0, 0, True), (3, 3, True), (3, 3, True)]


@pytest.mark.parametrize("bad", ["text", "lang"])
def test_ids_must_be_integers(documents, bad):
    with pytest.raises(TypeError):
        minhash.near_duplicates(documents([(1, "a")]), id_col=bad)
