"""The corpus pipeline: stages over ``documents``, each the work of one operator.

Every stage takes the documents that its predecessor kept, written as
Parquet and read again, and returns documents with the same columns; the
last returns the packed pieces. Toxic documents go, of equal texts the
largest doc_id stays, of near copies the smallest, secrets are masked in
the text (no document goes for them), and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from omoplate.llm.common import cut_lineage, table
from omoplate.llm.exact_dedup import drop_copies
from omoplate.llm.packing import pack_documents
from omoplate.llm.secrets import mask_secrets
from omoplate.llm.simhash import drop_near_copies
from omoplate.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), memory=0.08)  # beside other stages' workers


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("secrets", secret_masking), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A classifier and fingerprints cannot be written in SQL; tests hold the run against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
