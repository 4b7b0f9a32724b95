"""Raw tables: line-delimited JSON or CSV files, read as text with provenance, written as Parquet."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradeflow.sources import schemas, tables


def now_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def add_provenance(
    df: DataFrame, source: str, ingested_at: str | None = None, per_file: bool = False
) -> DataFrame:
    """Add one ingest instant for the batch and the source as given, or each row's own file."""
    origin = F.col("_metadata.file_path") if per_file else F.lit(source)
    return df.withColumns(
        {
            schemas.INGESTED_AT: F.lit(ingested_at or now_text()),
            schemas.SOURCE_FILE: origin,
        }
    )


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(schemas.CORRUPT, StringType(), True)])


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A line that is not JSON gives NULL business columns and keeps its text."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The header must name the columns in schema order: a reordered file fails, it is not swapped."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .csv(path)
    )


def file_manifest(rows: DataFrame) -> DataFrame:
    """One row per source file of a frame that is read from files: path, bytes, modification time, rows, and how many
    of them were parsed, are corrupt, or hold no value in any column.

    Counts are summed in the tasks that read the files. A file without rows is not listed. Whether a line is
    corrupt depends on all its columns, so all are read.
    """
    corrupt = F.col(schemas.CORRUPT).isNotNull()
    values = [F.col(c).isNotNull().cast("int") for c in rows.columns if c != schemas.CORRUPT]
    place = {"path": "file_path", "bytes": "file_size", "modified_at": "file_modification_time"}
    return (
        rows.select(
            *[F.col(f"_metadata.{field}").alias(name) for name, field in place.items()],
            corrupt.alias("_corrupt"),
            (F.greatest(*values, F.lit(0)) == 0).alias("_blank"),
        )
        .groupBy(*place)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col("_corrupt")).alias("parsed_rows"),
            F.count_if("_corrupt").alias("corrupt_rows"),
            F.count_if("_blank").alias("blank_rows"),
        )
    )


def ingest_orders(
    spark: SparkSession, source_path: str, output_path: str, per_file: bool = False
) -> DataFrame:
    return _store(read_json_lines(spark, source_path, schemas.RAW_ORDERS), source_path, output_path, per_file)


def ingest_inventory(
    spark: SparkSession, source_path: str, output_path: str, per_file: bool = False
) -> DataFrame:
    return _store(read_csv(spark, source_path, schemas.RAW_INVENTORY), source_path, output_path, per_file)


def ingest_price_events(
    spark: SparkSession, source_path: str, output_path: str, per_file: bool = False
) -> DataFrame:
    return _store(
        read_json_lines(spark, source_path, schemas.RAW_PRICE_EVENTS), source_path, output_path, per_file
    )


def _store(df: DataFrame, source_path: str, output_path: str, per_file: bool) -> DataFrame:
    return tables.overwrite(add_provenance(df, source_path, per_file=per_file), output_path)
