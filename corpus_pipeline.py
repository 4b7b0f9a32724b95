"""A corpus from raw documents to packed sequences: filters, deduplication, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.language import learn_dictionaries, with_language
from tradeflow.llm.mixing import mixed_documents
from tradeflow.llm.near_duplicates import distinct_documents
from tradeflow.llm.packing import pack_documents
from tradeflow.llm.quality import gram_model, with_quality
from tradeflow.llm.storage import Store, documents, free_name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the corpus model counts ``docs``.

    A null or empty text goes, as it has fewer than 20 words; equal rows are judged alike.
    """
    name = free_name(docs, "_quality")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = with_quality(docs, labels, gram_model(docs, labels), output=name)
    return judged.filter(F.col(name)["kept"]).select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin.

    A text that is null or has no letter goes, and so do all when no document names a language; equal rows are judged alike.
    """
    name = free_name(docs, "_language")
    named = with_language(docs, learn_dictionaries(docs), output=name)
    return named.filter(F.col(name)["accepted"]).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates.

    Of rows equal in doc_id and text one stays. Rows without doc_id, and texts without words, stay.
    """
    return distinct_documents(docs, Store(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source, the last one. Documents without words are taken while the budget lasts and do not change it.
    """
    return mixed_documents(docs, Store(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of fixed length.

    A null or empty text is one piece with the end id alone; every row is packed, repeated ones too.
    """
    return pack_documents(docs, Store(spark))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("language_id", keep_language),
    ("near_dedup", drop_near_duplicates),
    ("mix_sources", mix),
    ("pack", pack),
]

#: Signatures, dictionaries and the language-model ratio have no SQL form; tests hold each stage and the run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each one's rows are written before the next reads them.

    An empty table gives no rows at any stage. Extra columns are passed on up to the last stage, which has its own.
    """
    docs, store = documents(spark, sf_dir), Store(spark)
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = store.keep(stage(spark, docs, sf_dir), f"{number}-{name}")
        if number > 1:
            store.drop(f"{number - 1}-{STAGES[number - 2][0]}")
    return docs
