"""From raw documents to packed sequences: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows the one before it returned.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake.llm import mixing, packing, ppm, simhash, substring
from chargelake.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: null, without letters, or undecided."""
    return ppm.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of the smallest doc_id, of each group of near copies."""
    return simhash.near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the words of passages of 35 or more that occur again.

    Texts that lose nothing stay as they are; others are their kept words joined by one
    space, and n_chars follows. Documents stay, also with nothing left.
    """
    cut = substring.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    columns = []
    for field in docs.schema:
        if field.name == "text":
            column = text
        elif field.name == "n_chars":
            column = F.when(F.col("n_removed") > 0, F.length("kept").cast(field.dataType)).otherwise(
                F.col("row.n_chars"))
        else:
            column = F.col("row").getField(field.name)
        columns.append(column.alias(field.name))
    return cut.select(*columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source up to its target, in the order of the schedule."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences; ids are little-endian unsigned 32-bit token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("packed", packed),
]

#: learned language models, XXH64 and tokenizers have no SQL; tests hold a brute-force run
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
