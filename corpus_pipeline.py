"""A training corpus from ``documents``: five cleaning and filtering stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; ``run`` writes each result as Parquet in the shared scratch folder and reads
it again as the next stage's ``docs``. All stages but the last return the columns
of ``documents``; ``n_chars`` follows the text where a stage changes it.

Stages keep rows with nulls where no rule says otherwise: language ID drops null
texts and texts without letters; line dedup drops a document of which nothing is
left; near-dedup and decontamination keep empty texts, and tell rows with equal or null
ids apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import bpe, decontam, langid, linededup, neardup
from tallyflow.llm.common import table, written
from tallyflow.llm.queries import tokenizer_source


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language ID rejects: no letters, or no language that
    explains the text better than another."""
    found = langid.identify(docs, langid.learn(docs), prefix="__")
    return found.where("not __rejected").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated runs of lines; a document that consisted of
    such copies alone goes."""
    found = linededup.drop_repeated_lines(docs)
    touched = F.col("n_removed") > 0
    found = found.where(~touched | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(touched, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near-duplicates (five-word
    shingles, similarity of 0.8 or more)."""
    return neardup.without_copies(docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' token counts and digests of ids and decoded text."""
    return bpe.encode_documents(docs, tokenizer_source())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: No stage can be stated in SQL as a whole; tests/llm compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
