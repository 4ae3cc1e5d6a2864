"""Registered queries of the text operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.llm import (
    bpe_codec, chosen_path, html_text, language_id, merkle, outliers, pii, quality_pu, role_repair, simhash, sql, template_leaks, token_files, url_filter,
)
from lotflow.llm.texts import fold, table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED = [f"{name}.example.{top}/" for name in LISTED_NAMES for top in ("com", "net", "org")]


def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = quality_pu.learn(docs.where(fold("doc_id", 5) != 0), labels)
    scored = quality_pu.quality_scores(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_language_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(fold("doc_id", 3) != 1))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op4_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.places(spark, RULES, LISTED))


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op7_bpe_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.bpe_digests(table(spark, sf_dir, "documents"))


def op8_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_texts(pages, html_text.learn(pages))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(table(spark, sf_dir, "documents"))


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similarity_classes(table(spark, sf_dir, "documents"))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repairs(role_repair.damaged(table(spark, sf_dir, "conversations"))).drop("system")


def op12_simhash_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), share=simhash.SHARE)


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_template_leaks, op2_quality_pu, op3_language_pieces, op4_url_bloom, op5_pii_spans,
        op6_robust_outliers, op7_bpe_prefixes, op8_html_lstm, op9_token_files, op10_chosen_path,
        op11_role_repair, op12_simhash_parts, op13_merkle_proofs,
    )
}

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_PLACES = ", ".join(
    [f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in RULES]
    + [f"('block', NULL, '{place.partition('/')[0]}', '/{place.partition('/')[2]}')" for place in LISTED]
)

ORACLES: dict[str, str] = {
    "op11_role_repair": sql.ROLE_REPAIR,
    "op13_merkle_proofs": sql.MANIFEST,
    "op4_url_bloom": rf"""
        WITH places(verdict, rule, p_host, p_path) AS (VALUES {_PLACES}),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path
            FROM pages
        ),
        judged AS (
            SELECT host, path,
                   arg_max(rule, length(rule)) AS rule,
                   arg_max(verdict, length(rule)) FILTER (WHERE rule IS NOT NULL) AS by_rule,
                   bool_or(rule IS NULL) AS on_list
            FROM (SELECT DISTINCT host, path FROM parts)
            JOIN places ON (host = p_host OR ends_with(host, '.' || p_host)) AND starts_with(path, p_path)
            GROUP BY host, path
        )
        SELECT p.page_id, p.host, p.path, j.rule,
               coalesce(j.by_rule, CASE WHEN j.on_list THEN 'block' END, 'allow') AS verdict
        FROM parts p LEFT JOIN judged j ON p.host = j.host AND p.path = j.path
    """,
}
