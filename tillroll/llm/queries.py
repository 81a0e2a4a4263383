"""The registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binpack, bitslice, bwtmerge, crf, disclosure, itq, mergedrop, mincut, packing, ppm, quality, simhash, whitening
from .common import crc_mod, table
from .wordcache import LARGE_CACHE

Query = Callable[[SparkSession, str], DataFrame]


def html_extraction(spark: SparkSession, root: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return mincut.extract(table(spark, root, "pages"))


def quality_rules(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, counts, base_failed, failed, kept of every document."""
    return quality.score(table(spark, root, "documents"))


def embedding_dedup(spark: SparkSession, root: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return itq.near_duplicates(table(spark, root, "embeddings"))


def pii(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, counts, base_sha256, spans, n_term of every document."""
    return disclosure.scan(table(spark, root, "documents"))


def merge_dropout(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 of every document's dropped-merge segmentation, and whether it decodes to the text."""
    encoded = mergedrop.encode(table(spark, root, "documents"), verify=True, with_ids=False)
    return encoded.select("doc_id", "n_ids", "ids_crc32", "lossless")


def binary_packing(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    return packing.pack(table(spark, root, "documents"), cache=LARGE_CACHE)


def simhash_dedup(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    found = simhash.near_duplicates(table(spark, root, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def token_matrices(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every segment of the packed id matrices."""
    return binpack.segments(binpack.pack(table(spark, root, "documents"), cache=LARGE_CACHE))


def toxicity(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_tokens, spans of every document."""
    docs = table(spark, root, "documents")

    def held_out(doc_id: Column) -> Column:
        return crc_mod(doc_id, 5) == 0

    model = crf.fit(crf.labelled_rows(docs, table(spark, root, "labels"), held_out))
    return crf.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_toxic_tokens", "spans")


def language_id(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every document."""
    docs = table(spark, root, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = ppm.fit(ppm.training_rows(docs, ~held_out, "doc_id", "text", "lang"))
    return ppm.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = bwtmerge.remove_repeats(table(spark, root, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def target_resampling(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words of every document."""
    found = bitslice.resample(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def embedding_whitening(spark: SparkSession, root: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector and component."""
    return whitening.whiten(table(spark, root, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": html_extraction,
    "op2_quality_rules": quality_rules,
    "op3_embedding_dedup": embedding_dedup,
    "op4_pii": pii,
    "op5_merge_dropout": merge_dropout,
    "op6_packing": binary_packing,
    "op7_simhash_dedup": simhash_dedup,
    "op8_token_matrices": token_matrices,
    "op9_toxicity": toxicity,
    "op10_language_id": language_id,
    "op11_suffix_dedup": suffix_dedup,
    "op12_target_resampling": target_resampling,
    "op13_embedding_whitening": embedding_whitening,
}

#: Where SQL cannot express an operator, tests/llm holds its query against a brute-force version.
ORACLES: dict[str, str] = {"op2_quality_rules": quality.oracle_sql()}
