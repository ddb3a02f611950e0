"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe.llm import (
    codes,
    hosts,
    language,
    licenses,
    mixing,
    neighbours,
    packing,
    quality,
    secrets,
    simhash,
    spellings,
    topk,
    toxicity,
)
from cdcframe.llm.common import remainder, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return _judged(quality.score_quality(docs, model), quality.THRESHOLD)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op4_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return _judged(toxicity.score_toxicity(docs, model), toxicity.THRESHOLD)


def op5_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op6_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op7_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_language_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_language(docs, remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return language.predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_link_graph_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge_urls(table(spark, sf_dir, "pages"))


def op12_kd_tree_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(spellings.words(table(spark, sf_dir, "documents")))


def op13_norm_of_sum_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(*codes.compress(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_compression": op2_quality_compression,
    "op3_license_scan": op3_license_scan,
    "op4_toxicity_lexicon": op4_toxicity_lexicon,
    "op5_sainte_lague_mix": op5_sainte_lague_mix,
    "op6_first_fit_packing": op6_first_fit_packing,
    "op7_simhash_covering": op7_simhash_covering,
    "op8_language_backoff": op8_language_backoff,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_nn_descent": op10_nn_descent,
    "op11_link_graph_urls": op11_link_graph_urls,
    "op12_kd_tree_spellings": op12_kd_tree_spellings,
    "op13_norm_of_sum_codes": op13_norm_of_sum_codes,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.SQL,
    "op5_sainte_lague_mix": mixing.SQL,
    "op9_exact_top_k": topk.SQL,
    "op11_link_graph_urls": hosts.SQL,
    "op12_kd_tree_spellings": spellings.SQL,
    "op13_norm_of_sum_codes": codes.SQL,
}
