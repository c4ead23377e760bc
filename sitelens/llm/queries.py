"""The registered queries of the thirteen operators, one a contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import mixing, negatives
from sitelens.llm.common import read_table

#: A score of this or more predicts label 1.
THRESHOLD = 0.3


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    from public_tokenizers import path

    from sitelens.llm import packing
    from sitelens.llm.common import materialize

    cut = packing.pieces(read_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), added=True)
    cut = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    cut, n = materialize(cut, "pieces")
    return packing.packed(cut, ["doc_id", "piece", "start", "ids_crc32"], n)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85 or more."""
    from sitelens.llm import minhash

    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under cosine 0.95 or more."""
    from sitelens.llm import embeddings

    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from sitelens.llm import html

    got = html.extracted(read_table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier place holds."""
    from sitelens.llm import chunks

    got = chunks.deduplicated(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    kept = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return got.select("doc_id", (kept + removed).alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of sources takes of every document."""
    return mixing.mixed(read_table(spark, sf_dir, "documents"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier too."""
    from sitelens.llm import suffixes

    got = suffixes.deduplicated(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from sitelens.llm import syncmers

    return syncmers.edited(read_table(spark, sf_dir, "documents"))


def _classified(spark: SparkSession, sf_dir: str, module, parts: int, held: int) -> DataFrame:
    from sitelens.llm import classify as cl

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = module.train(docs, labels, keep=cl.fold("id", parts) != held)
    return module.score(docs, model).select(
        "doc_id", F.coalesce(cl.fold("doc_id", parts) == held, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows of fold 0 of 5 are held out."""
    from sitelens.llm import quality

    return _classified(spark, sf_dir, quality, 5, 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows of fold 2 of 4 are held out."""
    from sitelens.llm import toxicity

    return _classified(spark, sf_dir, toxicity, 4, 2)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under two tokenizers, linked, with the counts of their pairs."""
    from public_tokenizers import path

    from sitelens.llm import alignment

    return alignment.aligned(read_table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    from public_tokenizers import path

    from sitelens.llm import bpe

    file = path("word_bpe_49k.json")
    ids = bpe.encoded(read_table(spark, sf_dir, "documents"), file)
    # what the ids decode to, beside the ids
    got = bpe.decoded(ids, file, carried=True)
    return got.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are moved by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mined(read_table(spark, sf_dir, "embeddings").withColumn("label", moved), anchor=F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_packing, op2_minhash, op3_embeddings, op4_html, op5_substrings, op6_mixing, op7_suffixes, op8_syncmers, op9_quality, op10_toxicity,
                                   op11_alignment, op12_bpe, op13_negatives)}
ORACLE_SQL: dict[str, str] = {"op6_mixing": mixing.sql(), "op13_negatives": negatives.SQL}
