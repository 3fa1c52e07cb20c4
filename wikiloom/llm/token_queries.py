"""Queries over token ids: files, packing, automaton."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.bpe_automaton import encode_decode
from wikiloom.llm.packing import pack_documents
from wikiloom.llm.registry import query, table
from wikiloom.llm.simple8b import read_token_files, write_token_files

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
FILE_END, PACK_END = 0, 1


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE, FILE_END)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def packed(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, WORD_BPE, PACK_END).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


@query("op8_concat_cut")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query("op9_bpe_automaton")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), WORD_BPE).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
