"""Path-addressed Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: A stored row's identity: a hash of its file's path, and its number in the file.
ROW_ID = ("_file_hash", "_file_row")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def folder(spark: SparkSession, path: str):
    """(file system, path) of a folder in any store Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Length of all files of a table, from the listing alone."""
    files, where = folder(spark, path)
    return files.getContentSummary(where).getLength()


def drop(spark: SparkSession, path: str) -> None:
    files, where = folder(spark, path)
    files.delete(where, True)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while it has not been written yet."""
    try:
        return read(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or no rows of its declared schema while it has not been written yet."""
    table = read_if_present(spark, path)
    return spark.createDataFrame([], schema) if table is None else table


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the table and return the *stored* rows, so that later actions do not recompute them."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(table: DataFrame) -> DataFrame:
    """A stored Parquet table with ``ROW_ID``; every scan gives a row the same identity."""
    place = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
    return table.select("*", *[value.alias(name) for value, name in zip(place, ROW_ID)])


def single_values(table: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Those of ``columns`` that hold one value, or only NULL, in every row of a stored table, as literals of it.

    One pass that reads these columns only.
    """
    found = table.agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{c}_{name}") for c in columns for name, f in (("least", F.min), ("most", F.max), ("known", F.count))],
    ).first()
    one = [c for c in columns if found[f"{c}_known"] in (0, found["rows"]) and found[f"{c}_least"] == found[f"{c}_most"]]
    return {c: F.lit(found[f"{c}_least"]).cast(table.schema[c].dataType) for c in one}


def overwrite_parts(df: DataFrame, path: str, by: str) -> None:
    """Replace the table by one folder per value of ``by``, in one write."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
