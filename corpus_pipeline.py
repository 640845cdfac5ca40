"""A training corpus from raw documents: identify languages, drop copies and near
copies, mix the sources, encode.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns what the next one gets. ``run`` applies them to the documents table, every
stage's result being written as Parquet and read again.

All stages take any text: null and empty ones have no letters, so language ID drops
them; given to a later stage, they are copies of each other for exact dedup, stand alone
in near dedup, have size 0 for mixing and no ids. Very long texts stay whole. Ties go to
the smallest id, as each operator says. Rows that repeat an id count as documents of
their own, except that exact dedup keeps one of equal rows. An empty table goes through
as an empty table. Further columns are kept by all stages but the last; one that is named
like a column that a stage adds (kept, size, lang_pred) holds that stage's values from then on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkraster.llm import bpe, exact_dedup, langid, minhash, mixing
from sparkraster.llm.common import ship, stored
from sparkraster.llm.queries import held_out

#: No SQL: language ID is fitted, and BPE is not expressible.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters, and those right between two codewords
    (0.06 % of the check tables), go. Null ids are never held out, so they may be learned from."""
    ship(spark)
    model = langid.train(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return langid.predict(docs, model).where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of each group of documents that are equal but for white space; null ids last."""
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over five-word shingles; null ids stay."""
    ship(spark)
    return minhash.near_duplicates(docs, words=5, percent=80).where("kept").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it; documents without words are taken at their source's rate, too."""
    return mixing.mix(docs).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their digest, and that of the text decoded from them: (doc_id, n_tokens, ids_sha256, decoded_sha256, ids)."""
    ship(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
