"""The index that follows replaced pages: segments, tombstones, compaction, replay."""

from __future__ import annotations

from sitelens.operators import index as ix
from sitelens.session import scratch_path
from sitelens.sources import live_index as li


def _pages(spark, texts: dict):
    return spark.createDataFrame(list(texts.items()), "path string, html string")


def _rows(df):
    return sorted(map(str, df.select("term", "path", "fr", "offsets").collect()))


def test_random_saves_equal_an_index_of_the_last_texts(spark):
    """Pages come, are replaced, become empty; segments stay few; every state is that of the last texts."""
    import random

    rng = random.Random(5)
    folder, last = scratch_path(spark, "test-live"), {}
    for i in range(9):
        texts = {f"s/{rng.randrange(12)}": "".join(" ".join(rng.choice("abcdef") for _ in range(rng.randrange(5))) + "\n" for _ in range(rng.randrange(3))) for _ in range(4)}
        last |= texts
        now = li.save_pages(_pages(spark, texts), folder, most=3)
        assert len(now.segments) <= 3
        if i % 4 == 0:
            assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, last)))
    assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, last)))
    assert _rows(li.live_postings(spark, folder, words=["a"])) == _rows(ix.postings(_pages(spark, last)).where("term = 'a'"))
    assert sorted(r["path"] for r in li.live_paths(spark, folder).collect()) == sorted(last)
    gone = li.clear(spark, folder)
    assert gone > 0 and li.clear(spark, folder) == 0
    assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, last)))


def test_an_old_state_stays_readable(spark):
    folder = scratch_path(spark, "test-live-old")
    old = li.save_pages(_pages(spark, {"s/1": "a\n", "s/2": "b\n"}), folder)
    before = _rows(li.live_postings(spark, folder, old))
    li.save_pages(_pages(spark, {"s/1": "c\n"}), folder)
    li.compact(spark, folder, most=2)
    assert _rows(li.live_postings(spark, folder, old)) == before
    assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, {"s/1": "c\n", "s/2": "b\n"})))


def test_a_replayed_or_broken_save_changes_nothing(spark, monkeypatch):
    folder = scratch_path(spark, "test-live-replay")
    li.save_pages(_pages(spark, {"s/1": "a a\n"}), folder, batch=0)
    li.save_pages(_pages(spark, {"s/1": "b\n", "s/2": "c\n"}), folder, batch=1)
    want = _rows(li.live_postings(spark, folder))
    assert li.save_pages(_pages(spark, {"s/1": "other\n"}), folder, batch=1).n == li.state(spark, folder).n  # a replay
    with monkeypatch.context() as m:
        m.setattr(li, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            li.save_pages(_pages(spark, {"s/2": "lost\n"}), folder, batch=2)
        except RuntimeError:
            pass
    assert _rows(li.live_postings(spark, folder)) == want  # its tombstones are of no state
    li.save_pages(_pages(spark, {"s/3": "d\n"}), folder, batch=2)
    assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, {"s/1": "b\n", "s/2": "c\n", "s/3": "d\n"})))


def test_odd_saves(spark):
    folder = scratch_path(spark, "test-live-odd")
    assert li.state(spark, folder) == li.State(0, {}, -1) and li.live_paths(spark, folder).count() == 0
    li.save_pages(_pages(spark, {"s/0": "x\n"}).limit(0), folder)
    twice = spark.createDataFrame([("s/1", "a\n"), ("s/1", "b\n")], "path string, html string")
    li.save_pages(twice, folder)
    got = li.live_postings(spark, folder).collect()
    assert len(got) == 1 and got[0]["term"] in ("a", "b")


def test_words_reach_the_scan(spark):
    folder = scratch_path(spark, "test-live-pushed")
    li.save_pages(_pages(spark, {"s/1": "a b\n"}), folder)
    text = li.live_postings(spark, folder, words=["a"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,a)" in text or "In(term, [a])" in text


def test_a_save_whose_rows_prove_none_at_run_time(spark):
    """A page without words, and no page at all, behind a shuffle: adaptive execution drops the empty part of the plan."""
    folder = scratch_path(spark, "test-live-none")
    li.save_pages(_pages(spark, {"s/1": "a\n", "s/2": "b\n"}), folder)
    none = _pages(spark, {f"s/{i}": "c\n" for i in range(50)}).repartition(4, "path").where("html = 'never'")
    now = li.save_pages(none, folder)
    assert now.segments == {1: 2, 2: 0}
    assert _rows(li.live_postings(spark, folder)) == _rows(ix.postings(_pages(spark, {"s/1": "a\n", "s/2": "b\n"})))
