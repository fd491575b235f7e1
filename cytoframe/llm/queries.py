"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cytoframe.llm import chat, collocations, decontamination, html, language, packing, pieces, privacy, quality, rules, similarity, toxicity
from cytoframe.llm.tables import read_table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id, class_id, copy_id, n_links; edge cases as in `similarity.join`."""
    return similarity.join(read_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id, score, both views and kept; edge cases as in `quality.score_documents`."""
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id, held_out, lang_pred, score; edge cases as in `language.identify`."""
    return language.identify_documents(read_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `pages`: page_id, url, text, n_chars; edge cases as in `html.extract_pages`."""
    return html.extract_pages(read_table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: its base counts, base_failed and kept; edge cases as in `rules.judge`."""
    return rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id, held_out, score, predicted; edge cases as in `toxicity.score_documents`."""
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each conversation, and for conversation -7, read back from the formatted text; edge cases as in `chat.format_conversations`."""
    return chat.read_back(chat.format_conversations(chat.with_probe(read_table(spark, sf_dir, "conversations"))))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id and the text with surrogates; edge cases as in `privacy.anonymise`."""
    return privacy.anonymise(read_table(spark, sf_dir, "documents")).select("doc_id", "text")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: its words, hits and items; edge cases as in `decontamination.report`."""
    return decontamination.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence; edge cases as in `packing.pack`."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each of the best phrases of each language of `documents`; edge cases as in `collocations.mine`."""
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of `documents`: doc_id, n_tokens and the digests of its ids and of the decoded text; edge cases as in `pieces.encode_documents`."""
    return pieces.digests(pieces.encode_documents(read_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_ngram_jaccard, op2_quality_classifier, op3_language_id, op4_html_extraction, op5_quality_rules, op6_toxicity, op7_chat_formatting, op8_pii, op9_decontamination, op10_packing, op11_collocations, op12_sentencepiece)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_formatting": chat.ORACLE_SQL, "op9_decontamination": decontamination.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL}
