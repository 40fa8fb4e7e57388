"""From raw documents to token files: each stage reads what the one before it kept.

toxicity drops documents that score 0.7 or more; near_duplicates keeps the smallest doc_id of each group of texts
that are alike in five-word shingles (Jaccard similarity 0.8 or more);
decontamination drops documents that hold a benchmark passage; mixing takes each source's target number of
words, as rows with the words that a document gives in a pass; token_records encodes these rows in
ascending doc_id order and returns the index of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import decontaminate, mixing, near_copies, token_records
from cadenza.llm import toxicity as toxic
from cadenza.llm.common import table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    index = token_records.token_records(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("token_records", token_files),
]

#: SQL can express neither the learned scores nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
