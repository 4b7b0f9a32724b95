"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import text_arrays as ta
from tradeflow.llm.tokens import encoder, tokenizer_path

OVER_LIMIT = 512


def count_tokens(
    docs: DataFrame, text: str = "text", output: str = "n_tokens", tokenizer: str | None = None
) -> DataFrame:
    """``docs`` with the number of tokens of ``text`` as a last column; no other column changes.

    Only lengths leave the worker. A null or empty text has 0 tokens; repeated rows are counted each;
    an empty table stays empty. A column that is already called ``output`` is replaced.
    """
    return docs.withColumn(output, _counter(tokenizer or tokenizer_path())(F.col(text)))


def _counter(path: str):
    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = encoder(path)
        for batch in batches:
            yield pa.array(tokens.counts(ta.as_large(batch)), pa.int64())

    return n_tokens


def token_report(docs: DataFrame, limit: int = OVER_LIMIT, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document is longer than ``limit`` tokens."""
    text: Column = F.col("text")
    return count_tokens(docs.select("doc_id", "text"), tokenizer=tokenizer).select(
        "doc_id",
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
