"""From documents to packed sequences: language ID, exact, near and passage deduplication, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which ``run`` writes as Parquet and reads again as the
next stage's documents. All but the last return the columns of ``documents``.

* language ID: documents in which no language can be told (no letters, or none of the learnt n-grams) go;
* exact dedup: of texts that are equal up to white space the smallest doc_id stays;
* near dedup: of each group linked by five-word shingles at a similarity of 0.8 the smallest doc_id stays;
* substring dedup: passages of 50 words or more that an earlier document has are cut out, all documents stay;
* packing: pieces of at most 4,096 tokens with their sequence and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chaining, cuckoo, language, minhash, packing
from tidemark.llm.common import free_name, release, table
from tidemark.llm.queries import vocabulary
from tidemark.settings import shared_folder


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs)
    lang, score = (free_name(docs.columns, c) for c in ("told_lang", "told_score"))
    told = language.predict(docs, model, docs.columns, lang, score)
    return told.where((F.col(lang) != language.UNKNOWN) & (F.col(score) > 0)).drop(lang, score)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cuckoo.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)  # the shuffles of the stage before; the next one calls it itself
    return minhash.kept_documents(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chaining.without_passages(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", told_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]

#: Language decisions, similarity joins and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
