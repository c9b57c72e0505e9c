"""The operators applied to the whole benchmark tables, with their SQL."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_middle, grid_join, neighbours, packing, personal_data, pieces, secret_scan, similar, substrings
from . import top_k, toxicity, url_filter, vector_codes
from .common import table
from .oracles import ORACLES as LLM_ORACLES  # noqa: F401

# The rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.find_repeats(table(spark, sf, "documents")).select(
        "doc_id", "first_word", "end_word", "source_id", "source_first", "source_end", "links"
    )


def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    file = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(table(spark, sf, "documents"), file), file)
    return found.select("doc_id", F.size("ids").alias("n_pieces"), "ids", F.crc32("text").alias("decoded_crc32"))


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return personal_data.find(docs, personal_data.train(docs))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_learned_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base, spans = F.col("base"), F.array_sort(F.concat("base", "extra"))
    return found.select(
        "doc_id",
        *[secret_scan.count_of(base, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


def op10_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    found = similar.similarity_classes(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_grid_order_join(spark: SparkSession, sf: str) -> DataFrame:
    return grid_join.near_vectors(table(spark, sf, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = vector_codes.integer_vectors(table(spark, sf, "embeddings"))
    books = vector_codes.train(vectors)
    found = vector_codes.label_errors(vector_codes.encode(vectors, books))
    digest = hashlib.sha256(vector_codes.numbers(books).encode()).hexdigest()
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    found = fill_middle.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_sentencepiece,
        op3_url_filter,
        op4_exact_top_k,
        op5_personal_data,
        op6_toxicity,
        op7_best_fit_packing,
        op8_learned_partitions,
        op9_secret_scan,
        op10_ngram_jaccard,
        op11_grid_order_join,
        op12_vector_codes,
        op13_fill_in_middle,
    )
}
