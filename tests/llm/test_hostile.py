"""Hostile rows: very long white space, extreme ids, several texts of an id, colliding words, repeated labels."""

import numpy as np
import pytest
from brute import near_duplicates, without_repeats
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitelens.llm import chunks, classify, common, minhash, packing, suffixes, syncmers, textbatch


def test_two_million_blanks_are_encoded():
    text = "a" + " " * 2_000_000 + "b<|endoftext|>c"
    for added in (False, True):
        library = Tokenizer.from_file(path("byte_bpe_50k.json"))
        library.encode_special_tokens = not added
        assert packing.encoder(path("byte_bpe_50k.json"), added)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def _thue_morse(n, swap=False):
    a, b = ("b", "a") if swap else ("a", "b")
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_long_words_are_told_apart(documents):
    one, two = _thue_morse(1024), _thue_morse(1024, True)
    data = np.frombuffer((one + two).encode(), np.uint8)
    start, end = np.array([0, 1024]), np.array([1024, 2048])
    prefix = textbatch.prefix_hash(data)
    assert len(set(textbatch.span_hash(prefix, start, end).tolist())) == 1  # powers modulo 2**64 cannot tell them
    assert len(set(textbatch.exact_hash(data, start, end).tolist())) == 2
    rows = [(1, one), (2, two), (3, one + " w x y z"), (4, two + " w x y z")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(rows), 85).collect()}
    assert got == near_duplicates(rows, 85)


def _several(documents):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(words, n))
    shared = text(60)
    return documents([(1, text(20) + shared), (7, text(30)), (7, shared + text(5)), (7, text(50) + shared), (7, "short"), (7, None), (9, shared), (None, shared)] + [(7, text(40)) for _ in range(300)])


def test_many_texts_of_one_id(documents):
    """Place of a text among those of its id: the order of its hash."""
    docs = _several(documents)
    given = docs.withColumn("tag", F.xxhash64("text")).where("doc_id is not null").orderBy("doc_id", "tag").select("text").collect()
    want = without_repeats([(i, r.text) for i, r in enumerate(given)], suffixes.LENGTH)
    got = suffixes.deduplicated(docs).where("doc_id is not null").collect()
    assert sorted((bytes(r.kept), r.n_bytes - len(r.kept), len(r.spans)) for r in got) == sorted(want.values())
    kept = chunks.deduplicated(docs).collect()
    assert len(kept) == docs.count() and any(r.spans for r in kept)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_texts_of_an_id_by_a_shuffled_join(documents, monkeypatch, limit):
    monkeypatch.setattr("sitelens.session.BROADCAST_BYTE_LIMIT", limit)
    docs = _several(documents)
    got = common.told_apart(docs, common.several_texts(docs, "doc_id", "text"), "doc_id", "text")
    assert got.where("tag_ <> 0").select("id_").distinct().collect()[0].id_ == 7
    assert got.where("id_ = 7 and tag_ = 0").count() == 0 and got.count() == docs.count()
    assert common.several_texts(docs.where("doc_id <> 7"), "doc_id", "text") is None


def test_extreme_ids(documents):
    low, high = -(2**63), 2**63 - 1
    rows = [(low, "the first text of all " * 9), (high, "another text altogether " * 9), (0, "x"), (None, "y"), (low + 1, "z")]
    got = {r.doc_id: r for r in syncmers.edited(documents(rows)).collect()}
    assert set(got) == {low, high, 0, None, low + 1}
    assert got[high].n_chars == len(rows[1][1])


def test_the_sample_is_bounded_by_rows_and_bytes(spark, documents, monkeypatch):
    docs = documents([(1, "hot text")] * 500 + [(1, "another")] + [(i, "t" * (10 * i)) for i in range(2, 40)] + [(50, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    sample = lambda bound: classify.labelled_sample(docs, labels, "quality", F.lit(True), "doc_id", "text", bound)
    got = sample(1000).collect()
    assert sorted(r.id for r in got) == [*range(1, 40), 50]
    monkeypatch.setattr(classify, "MAX_BYTES", 1000)
    some = sample(1000).orderBy("rank").collect()
    assert 0 < len(some) < 40 and sum(len(r.text or "") for r in some) <= 1000
    assert [r.id for r in some] == [r.id for r in sorted(got, key=lambda r: r.rank)][: len(some)]
    monkeypatch.setattr(classify, "MAX_BYTES", 0)
    assert len(sample(1000).collect()) >= 1


def test_a_document_without_id_loses_its_own_repeats(documents):
    rng = np.random.default_rng(12)
    part = " ".join(rng.choice([f"v{i}" for i in range(900)], 120))
    text = part + " # " + part + " ... " + part
    got = suffixes.deduplicated(documents([(None, text), (3, text), (None, part)])).collect()
    want = without_repeats([(3, text)], suffixes.LENGTH)[3]
    assert sorted((bytes(r.kept), r.n_bytes - len(r.kept), len(r.spans)) for r in got) == sorted([want, want, (part.encode(), 0, 0)])
    kept = {(r.doc_id, r.text) for r in chunks.deduplicated(documents([(None, text), (3, text), (None, part)])).collect()}
    assert len({t for _, t in kept}) == 2 and (None, part) in kept and any(len(t) < len(text) for _, t in kept)


def test_near_copies_keep_the_first_text_of_an_id(spark, documents):
    """Different texts of one id: the same row whatever the order and the partitions."""
    import corpus_pipeline

    same = "one two three four five six seven"
    rows = [(1, "b other words stand here alone"), (1, None), (1, "a few words stand here alone"), (2, same), (3, same), (4, None), (None, "x"), (None, "x")]
    for given in (rows, rows[::-1]):
        kept = corpus_pipeline.drop_near_copies(spark, documents(given).repartition(5), "").select(*corpus_pipeline.COLUMNS).collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "x"), (0, "x"), (1, "a few words stand here alone"), (2, same), (4, "")]
