"""A corpus pipeline of five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet and read again as the next one's docs. All but the last return the columns of
documents. An empty table passes all of them and stays empty; extra columns stay to the
last but one stage, whatever they are called.
"""
from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import exact_dedup, language_id, minhash, mixing, packing
from pluvio.llm.common import store
from pluvio.llm.queries import tokenizer_paths

#: A document whose n-grams are less in place than this in every profile is in none of
#: the languages.
LEAST_SCORE = 0.15


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those without a letter (null and empty
    texts among them), and those far from every profile, go. Rows are judged by their text
    alone, so repeated rows and null ids fare alike; a null lang only isn't learnt from."""
    found = language_id.identify(docs)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the one with
    the smallest id, null ids last, and one of rows that repeat."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five words, similarity 0.8. Texts
    without words and rows with a null id stay."""
    return minhash.drop_near_copies(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: no more than twice. A null source is a
    source; a text without words stays once; rows that repeat are drawn one by one."""
    return mixing.mix_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, with their token ids, in sequences of 1,024. A null
    text makes the piece of the end id alone; copies make pieces of their own."""
    pieces = packing.token_pieces(docs, *tokenizer_paths(), with_ids=True)
    return packing.pack(pieces).drop("loss")


STAGES = [("language ID", identify_language), ("exact dedup", drop_exact_copies), ("MinHash near-dedup", drop_near_copies),
          ("mixing sources", mix_sources), ("packing", pack_sequences)]

#: SQL can't express MinHash, entropy balancing or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return functools.reduce(lambda d, stage: store(stage[1](spark, d, sf_dir)), STAGES, docs)
