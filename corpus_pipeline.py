"""A training corpus in five stages: quality rules, near-duplicates, personal data, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Columns are looked up by name, missing ones are null, others are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, jaccard, mixing, pii, quality
from tessera.llm.common import DOCUMENT, keep, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep. Null and blank texts have no words and go; each of
    several rows of one id or text is judged by its own text, so repeated rows stay or go together."""
    return quality.judge(docs, table(spark, sf_dir, "labels")).where("kept").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more: that with the least
    id, null last; ties and repeated rows as in keep_first. Null and blank texts are linked with nothing and all stay."""
    return jaccard.keep_first(docs, n=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text where that changes. Null and blank
    texts hold none; repeated rows change alike."""
    found = pii.find_pii(docs).select("doc_id", F.col("redacted").alias("text"), "lang", "source", "n_chars", (F.size("all_spans") > 0).alias("changed"))
    n_chars = F.when(F.col("changed"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it. A null source is one of its own; null and blank texts have
    size 0 and are taken at their source's rate; repeated rows draw alike."""
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, as digests of its ids and of the text decoded from them: a row for each row, whether ids
    repeat or are null; null and empty texts have no tokens."""
    path = bpe.vocabulary("byte_bpe_50k.json")
    return bpe.digest(docs, path)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing sources", mixing_sources),
    ("bpe encoding", bpe_encoding),
]
#: The forest, the trees and BPE have no SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = keep(docs, f"stage{i}")
    return docs
