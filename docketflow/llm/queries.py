"""The queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm import sql
from docketflow.llm.byte_bpe import round_trip
from docketflow.llm.frames import importable, table
from docketflow.llm.line_dedup import without_shared_lines
from docketflow.llm.merkle import dataset_manifest
from docketflow.llm.near_dedup import near_groups
from docketflow.llm.packing import pack
from docketflow.llm.prefix_trie import conversation_trie
from docketflow.llm.quality_model import scored, train
from docketflow.llm.rules import judge
from docketflow.llm.secrets import secret_spans
from docketflow.llm.token_counts import token_counts
from docketflow.llm.token_files import read_digests, write_tokens
from docketflow.llm.top_k import top_k
from docketflow.llm.warc import read_records, write_pages

WORD_BPE, BYTE_BPE, MULTI_BPE = (
    "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken")
TOKENS_END, PACK_END = 2, 1


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(importable(spark), sf_dir, "documents")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(importable(spark), sf_dir, "pages")
    return (
        read_records(write_pages(pages), payloads=False).where("record_type <> 'warcinfo'")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                "target_uri")
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), words=3, percent=85)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), vocabulary(WORD_BPE))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(importable(spark), sf_dir, "embeddings"))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), vocabulary(WORD_BPE), PACK_END)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), vocabulary(MULTI_BPE), split_pattern())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_tokens(documents(spark, sf_dir), vocabulary(BYTE_BPE), TOKENS_END)
    return read_digests(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return without_shared_lines(docs).select(
        "doc_id", "lines_deleted", "words_deleted",
        F.octet_length("text").cast("long").alias("n_bytes"), "text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(importable(spark), sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_manifest(documents(spark, sf_dir))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc, op2_near_dedup, op3_token_counts, op4_top_k, op5_quality_model,
        op6_quality_rules, op7_packing, op8_byte_bpe, op9_token_files, op10_line_dedup, op11_prefix_trie, op12_merkle_manifest,
        op13_secret_scan)
}

#: DuckDB SQL for the queries that it can express.
ORACLE: dict[str, str] = {
    "op1_warc": sql.WARC,
    "op2_near_dedup": sql.near_sql(3, 85),
    "op4_top_k": sql.TOP_K,
    "op6_quality_rules": sql.repetition_sql(),
    "op11_prefix_trie": sql.TRIE,
    "op12_merkle_manifest": sql.MERKLE,
    "op13_secret_scan": sql.SECRETS,
}
