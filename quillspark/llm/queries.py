"""The corpus operators' queries: thin applications to whole tables, with the results that the contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import best_fit, chat, collocations, decontaminate, html_text, knn_quality, packing, secrets, simhash, spelling, srs, substrings, toxicity
from quillspark.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_srs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srs.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=3)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("redacted", F.lit("")).cast("binary"), 256)
    return found.select("doc_id", "n_candidates", F.size("findings").cast("long").alias("n_findings"), "findings", digest.alias("redacted_sha256"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000, share=80)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), shortest=7, least=2, ratio=10, every=31)


QUERIES = {
    "op1_srs": op1_srs,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_decontaminate": op5_decontaminate,
    "op6_secrets": op6_secrets,
    "op7_html": op7_html,
    "op8_substrings": op8_substrings,
    "op9_chat": op9_chat,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_best_fit": op12_best_fit,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL = {
    "op5_decontaminate": decontaminate.ORACLE_SQL,
    "op8_substrings": substrings.ORACLE_SQL,
    "op9_chat": chat.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op13_spelling": spelling.ORACLE_SQL,
}
