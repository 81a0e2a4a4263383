"""Corpus preparation pipeline: toxicity, quality rules, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import crf, disclosure, packing, quality, simhash
from tillroll.llm.common import crc_mod, table
from tillroll.session import checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field does not call toxic.  It learns from the labelled documents of ``sf_dir``
    whose crc32(doc_id) mod 5 is not 0; null texts are not toxic."""
    labels = table(spark, sf_dir, "labels")
    model = crf.fit(crf.labelled_rows(table(spark, sf_dir, "documents"), labels, lambda i: crc_mod(i, 5) == 0))
    return crf.keep_clean(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the words that disclose it generalised; n_chars is that of the new text."""
    out = disclosure.sanitise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

#: The stages learn a field, search fingerprints and encode tokens, which SQL cannot express: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents of ``sf_dir``; what each stage returns is written to the shared folder."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
