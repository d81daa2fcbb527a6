"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

language_id drops documents whose language is not recognised, line_dedup takes out fuzzily repeated lines, near_dedup keeps
one document of each group of near copies, source_mix draws the documents to target weights per source, packing fills
sequences. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from firmweave.llm import language_id, line_dedup, mixing, near_dedup, packing
from firmweave.llm.common import Stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the models learn from the documents' own ``lang``."""
    rejected = language_id.result_names(docs.columns)["rejected"]
    found = language_id.identify(docs, docs, keep_text=True)
    return found.where(~found[rejected]).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; empty documents stay."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents that a mix of 150 % of all words takes, sources weighing 5, 2, 1."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their place in sequences of 2,048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", languages),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("source_mix", mix),
    ("packing", pack),
]

#: No SQL states the language models, the SimHash and the draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Stages(spark) as st:
        for name, stage in STAGES[:-1]:
            docs = st.save(stage(spark, docs, sf_dir), name)
            st.keep_only(docs)
        name, stage = STAGES[-1]
        return st.save(stage(spark, docs, sf_dir), name, keep=True)
