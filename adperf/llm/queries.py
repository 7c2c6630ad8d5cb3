"""The operators as queries over the test tables, and the SQL that checks those which SQL can express.

Each query applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adperf.llm import chat, langid, mixing, nn_descent, odd_sketch, packing, periodic, quality, spotsigs, tokens, toxicity, urls, whitening
from adperf.llm.common import read, stored


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_edits(read(spark, sf_dir, "documents"))


def spot_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.near_documents(read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), mixing.WEIGHTS)


def op5_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_embeddings(read(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_language(read(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_conversation(read(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_conversations(turns))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.with_planted_period(read(spark, sf_dir, "documents"))))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(quality.ledger(read(spark, sf_dir, "documents")))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ablations(stored(quality.ledger(read(spark, sf_dir, "documents")), "quality-ledger"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_spot_signatures, op3_url_filter, op4_source_mix, op5_embedding_links, op6_packing, op7_toxicity, op8_language_id,
        op9_chat_formatting, op10_near_duplicates, op11_periodic_runs, op12_embedding_whitening, op13_quality_rules, quality_ablations,
        spot_near_documents,
    )
}
ORACLE = {
    "op3_url_filter": urls.SQL, "op4_source_mix": mixing.SQL, "op9_chat_formatting": chat.SQL, "op13_quality_rules": quality.SQL,
    "quality_ablations": quality.ABLATION_SQL,
}
