"""The operators bound to their tables with production parameters.

Each query reads its whole table and returns its whole result; the digest
columns that a contract asks for are derived here from the operators' outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import bpe, centroids, decontam, langid, license_scan, linededup, neardup, periodic, pii, search, secret_scan, spans, toxicity, winnow
from tallyflow.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_source(name: str = TOKENIZER) -> str:
    """The tokenizer file's text (on the driver; tasks get it with their code)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_license_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without the later copies, n_lines, n_removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted", "llr")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op6_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.digest(pii.personal_data(table(spark, sf_dir, "documents")), pii.BASE)


def op7_aho_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.digest(secret_scan.secrets(table(spark, sf_dir, "documents")), secret_scan.BASE)


def op8_lang_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_source())


def op10_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 50."""
    docs = table(spark, sf_dir, "documents")
    return search.search(docs, docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the texts with the periodic tails that ids with crc32 divisible by ten get."""
    return periodic.describe(table(spark, sf_dir, "documents"), periodic.planted)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_license_zstd": op2_license_zstd,
    "op3_line_dedup": op3_line_dedup,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_minhash": op5_minhash,
    "op6_crf_pii": op6_crf_pii,
    "op7_aho_secrets": op7_aho_secrets,
    "op8_lang_zstd": op8_lang_zstd,
    "op9_bpe_trie": op9_bpe_trie,
    "op10_bm25_wand": op10_bm25_wand,
    "op11_winnowing": op11_winnowing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_centroids": op13_centroids,
}

ORACLE: dict[str, str] = {"op13_centroids": centroids.oracle_sql()}
