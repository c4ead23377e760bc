"""The training-corpus pipeline: toxicity, near duplicates, repeated substrings, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it and reads it again as the next stage's documents.  All stages but
the last return the columns of ``documents``.  Columns of the input beyond
those are not passed on, and no stage takes an unbounded group to one task.

Defined results: a null text stays null until packing, where it is empty;
repeated rows of an id are one document to the near-duplicate stage, which
keeps the one with the first text; an empty table passes through all stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import chunks, minhash, mixing, packing, toxicity
from sitelens.llm.common import materialize, read_table
from sitelens.llm.queries import THRESHOLD

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose toxicity score is this or more is rejected: toxic by the operator's own decision.
REJECTED = THRESHOLD
#: Jaccard similarity of five-word shingles, in hundredths, from which documents are near copies.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, does not reject."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, keep=F.lit(True))
    scored = toxicity.score(docs, model, carried={c: F.col(c) for c in COLUMNS})
    return scored.where(F.col("score") < REJECTED).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id,
    and of that id's rows the one with the first text (a null only where there is no other)."""
    kept = minhash.near_duplicates(docs, percent=NEAR).where("kept and doc_id is not null").select("doc_id").distinct()
    one = docs.join(kept, "doc_id", "left_semi")
    first = F.min(F.struct(F.col("text").isNull().alias("none"), "text", *[c for c in COLUMNS if c not in ("doc_id", "text")])).alias("row")
    one = one.groupBy("doc_id").agg(first).select("doc_id", "row.*").select(*COLUMNS)
    return one.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds."""
    got = chunks.deduplicated(docs, carry=("lang", "source"))
    return got.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: the words taken over its
    size, to the nearest whole number (a part occurs once a source and shard).
    Documents without words cost nothing and stay."""
    got = mixing.mixed(docs, carry=("text", "lang", "n_chars", "source"))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(1).cast("int")
    return got.withColumn("time", F.explode(F.array_repeat(F.lit(1), times))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their token ids and their places in sequences."""
    from public_tokenizers import path

    cut, n = materialize(packing.pieces(docs, path("byte_bpe_50k.json"), added=True).withColumn("ids_crc32", F.crc32("ids")), "pieces")
    return packing.packed(cut, ["doc_id", "piece", "start", "ids_crc32"], n)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substrings", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
#: Tokenizing and training have no SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return docs
