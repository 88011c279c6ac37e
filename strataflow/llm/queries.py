"""One query per corpus operator, with production parameters over whole tables, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm.ann import nearest
from strataflow.llm.bpe import bpe_roundtrip
from strataflow.llm.conversation_trie import conversation_trie
from strataflow.llm.exact_dedup import exact_groups
from strataflow.llm.html_text import html_text
from strataflow.llm.packing import packed
from strataflow.llm.periodic_runs import periodic_runs
from strataflow.llm.quality import quality
from strataflow.llm.simhash import near_duplicates
from strataflow.llm.suffix_dedup import remove_repeats
from strataflow.llm.token_counts import token_counts
from strataflow.llm.token_files import read_token_files, write_token_files
from strataflow.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"))


ORACLE["op3_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, digest AS text_sha256
FROM d WINDOW w AS (PARTITION BY digest)
"""


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_roundtrip(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_token_files(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=0,
        vocabulary=50_257,
    )
    return read_token_files(spark, folder)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packed(read(spark, sf_dir, "documents"), tokenizer, end_id=1)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4, bits=4)


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(read(spark, sf_dir, "documents"), pieces)


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), k=20, query_every=20)[0]


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), length=200)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"), rearrange=True)


@query
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(read(spark, sf_dir, "pages"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read(spark, sf_dir, "conversations"), rebuild=True)
