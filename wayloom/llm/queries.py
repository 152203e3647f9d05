"""The operators as queries over the given tables, by the contracts' columns, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.llm import codes, decontaminate, html, jaccard, language, lines, lm, oracles, packing, prefixes, secrets, topk, toxicity, url_filter
from wayloom.llm.common import fold

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, fold("doc_id", 3) != 1)
    predicted = (F.col("score") >= toxicity.REJECT_FROM).cast("int")
    return scored.select(
        F.col("doc.doc_id").alias("doc_id"), (~F.col("training")).alias("held_out"), "score", predicted.alias("predicted")
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = language.identify_language(table(spark, sf_dir, "documents"), fold("doc_id", 4) != 2)
    return predicted.select("doc_id", (~F.col("_training")).alias("held_out"), "lang_pred", "score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("pattern")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host", "path")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(codes.compress(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_toxicity,
        op3_jaccard_join,
        op4_packing,
        op5_line_dedup,
        op6_lm_scoring,
        op7_language_id,
        op8_exact_top_k,
        op9_decontamination,
        op10_url_filters,
        op11_html_extraction,
        op12_prefix_trie,
        op13_vector_codes,
    )
}

#: The others are beyond SQL: trained models (2, 6, 7), a tokenizer (4) and a reader of markup (11). Tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_secret_scan": oracles.secret_scan(),
    "op3_jaccard_join": oracles.jaccard_join(),
    "op5_line_dedup": oracles.line_dedup(),
    "op8_exact_top_k": oracles.exact_top_k(),
    "op9_decontamination": oracles.decontamination(),
    "op10_url_filters": oracles.url_filters(),
    "op12_prefix_trie": oracles.prefix_trie(),
    "op13_vector_codes": oracles.vector_codes(),
}
