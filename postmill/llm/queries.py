"""One query per operator, over whole tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postmill.llm import (
    bagminhash,
    containment,
    content_archive,
    conversation_repair,
    crf,
    host_reputation,
    huffman_ids,
    quality_ratio,
    secret_tests,
    suffix_dedup,
    systematic_mix,
    vector_codes,
    vector_packing,
)

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.languages(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman_ids.encoded(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_archive.archived(table(spark, sf_dir, "pages"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = host_reputation.label_outcomes(table(spark, sf_dir, "labels"))
    return host_reputation.verdicts(table(spark, sf_dir, "pages"), outcomes)


def op7_secret_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_tests.secrets(table(spark, sf_dir, "documents"))


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return systematic_mix.mix_report(table(spark, sf_dir, "documents"))


def op9_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.packing_report(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_crf": op1_crf,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_bagminhash": op3_bagminhash,
    "op4_huffman_ids": op4_huffman_ids,
    "op5_content_archive": op5_content_archive,
    "op6_host_reputation": op6_host_reputation,
    "op7_secret_tests": op7_secret_tests,
    "op8_systematic_mix": op8_systematic_mix,
    "op9_containment": op9_containment,
    "op10_quality_ratio": op10_quality_ratio,
    "op11_vector_codes": op11_vector_codes,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_packing": op13_vector_packing,
}

NIBBLES = ", ".join(f"'{i:04b}'" for i in range(16))

ORACLE_SQL: dict[str, str] = {
    # A SHA-1 in base32: its hex digits as bits, read five at a time.
    "op5_content_archive": f"""
        with hashed as (
          select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
        bits as (
          select *, array_to_string(list_transform(string_split(hex, ''),
            lambda h: [{NIBBLES}][strpos('0123456789abcdef', h)]), '') as bits from hashed)
        select page_id, octet_length(encode(html)) as payload_bytes,
          array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + cast(list_sum(list_transform(range(5), lambda j:
              cast(substr(bits, cast(5 * i + j + 1 as bigint), 1) as bigint) * (16 >> cast(j as integer)))) as bigint), 1)), '') as payload_digest,
          case when page_id = min(page_id) over same then 'response' else 'revisit' end as record_type,
          case when page_id <> min(page_id) over same then min(page_id) over same end as refers_to
        from bits window same as (partition by html)""",
}
