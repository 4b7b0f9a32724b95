"""Rewriting a stored table with better file sizes or better clustering; the rows stay the same."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.operators import changelog
from tradeflow.sources import tables

#: One task writes a file, so a file is no more than one scan split (``spark.sql.files.maxPartitionBytes``).
BYTES_PER_FILE = 1 << 27
#: Rows of a clustered file are sorted in one task, which holds them decoded.
SORTED_BYTES = 1 << 27
BITS = 6
MAX_Z_COLUMNS = 8
#: Bytes of a text that count for its place, after those that all texts of the column share.
PLACE_BYTES = 7
#: Ranks of cut points are right to a fraction of a range's rows.
RANK_STEPS_PER_RANGE = 50


def compact(
    spark: SparkSession, path: str, output_path: str, rows_per_file: int | None = None, bytes_per_file: int = BYTES_PER_FILE
) -> DataFrame:
    """Copy the table at ``path`` into files of about ``bytes_per_file``, or ``rows_per_file`` where given.

    Merging small files joins neighbouring scan splits without a shuffle; only a table in fewer
    splits than the wanted files is redistributed. Bytes come from the listing, rows from the footers.
    """
    df = _plain_table(spark, path)
    files = _files(spark, path, df, rows_per_file, bytes_per_file)
    # Splits never exceed spark.sql.files.maxPartitionBytes, so merged tasks stay near one file each.
    sized = df.coalesce(files) if df.rdd.getNumPartitions() >= files else df.repartition(files)
    return _write(sized, output_path, rows_per_file)


def cluster(
    spark: SparkSession,
    path: str,
    output_path: str,
    columns: Sequence[str],
    rows_per_file: int | None = None,
    bits: int | None = None,
    bytes_per_file: int = BYTES_PER_FILE,
) -> DataFrame:
    """Copy the table at ``path`` so that rows near each other in all ``columns`` share files.

    A file has at most about ``bytes_per_file``, and about ``SORTED_BYTES`` of decoded rows, as its rows are sorted
    by one task; or ``rows_per_file`` where given. Min/max statistics in the Parquet footers then skip files and row groups for filters on any of
    the columns.
    """
    df = _plain_table(spark, path)
    names = df.columns
    files = _files(spark, path, df, rows_per_file, bytes_per_file)
    if not rows_per_file:
        files = max(files, ceil(decoded_bytes(df) / SORTED_BYTES))
    bits = bits or _bits(files, len(columns))
    places = {c: place_of(df, c) for c in known_columns(df, columns)}
    cuts = cut_points(df, places, bits)
    # The position within the source file splits a z value, or copies of a row, over several files.
    placed = df.select(
        *names, z_value([bucket(place, cuts[c]) for c, place in places.items()], bits).alias("_z"),
        F.col("_metadata.row_index").alias("_position"),
    )
    # Within a z value the columns themselves decide, so a column's values stay together there too.
    order = ["_z", *columns, "_position"]
    ranged = placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return _write(ranged.select(*names), output_path, rows_per_file)


def optimize_table(
    spark: SparkSession, path: str, output_path: str, zorder_by: Sequence[str] | None = None
) -> DataFrame:
    """``cluster`` when columns are named, else ``compact``; a change log stays a change log."""
    if changelog.is_log(spark, path):
        return changelog.optimize_log(spark, path, output_path, zorder_by)
    if zorder_by:
        return cluster(spark, path, output_path, zorder_by)
    return compact(spark, path, output_path)


def _plain_table(spark: SparkSession, path: str) -> DataFrame:
    if changelog.is_log(spark, path):
        raise ValueError(f"{path} is a change log; optimize_log keeps its versions")
    return tables.read(spark, path)


def _files(spark: SparkSession, path: str, df: DataFrame, rows_per_file: int | None, bytes_per_file: int) -> int:
    if rows_per_file:
        return max(1, ceil(df.count() / rows_per_file))
    return max(1, ceil(tables.stored_bytes(spark, path) / bytes_per_file))


def decoded_bytes(df: DataFrame) -> int:
    """Bytes of all rows as a sort holds them: eight a column, and the contents of texts and nested values."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    row = F.lit(8 * (len(df.columns) + 4))
    for field in df.schema.fields:
        if not isinstance(field.dataType, fixed):
            text = F.col(field.name) if isinstance(field.dataType, T.BinaryType) else F.col(field.name).cast("string")
            row = row + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0]


def _bits(files: int, columns: int) -> int:
    """Enough buckets per column for several z values per file, within 62 bits for all columns."""
    return max(BITS, min(62 // max(columns, 1), 14, ceil((files.bit_length() + 2) / max(columns, 1))))


def known_columns(df: DataFrame, columns: Sequence[str]) -> Sequence[str]:
    if not columns or len(columns) > MAX_Z_COLUMNS:
        raise ValueError(f"name between 1 and {MAX_Z_COLUMNS} columns to cluster by")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return columns


def place_of(df: DataFrame, column: str) -> Column:
    """A number that follows the order of the column's values; NULL for NULL and NaN.

    A text's number is made of its first bytes after those that the least and the greatest text share, and
    so all texts between them.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.NumericType):
        return value
    if isinstance(kind, T.BooleanType):
        return value.cast("int")
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    coded = F.hex(F.encode(value.cast("string"), "UTF-8"))
    least, greatest = (c or "" for c in df.agg(F.min(coded), F.max(coded)).first())
    shared = len(os.path.commonprefix([least, greatest])) // 2 * 2
    digits = F.rpad(F.substring(coded, shared + 1, 2 * PLACE_BYTES), 2 * PLACE_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def cut_points(df: DataFrame, places: Mapping[str, Column], bits: int = BITS) -> dict[str, list]:
    """Up to ``2**bits - 1`` numbers per column that split its places evenly.

    One aggregate over the whole table makes a quantile summary of every column in the tasks and merges
    them; only the cut points reach the driver. Like the bounds of a range shuffle they decide where rows
    go, never which rows there are.
    """
    wanted = 2**bits
    shares = F.array(*[F.lit(k / wanted) for k in range(1, wanted)])
    found = df.agg(*[F.percentile_approx(place, shares, wanted * RANK_STEPS_PER_RANGE).alias(c) for c, place in places.items()]).first()
    return {c: sorted(set(found[c] or [])) for c in places}


def bucket(value: Column, cuts: Sequence) -> Column:
    """Number of cut points at or below the value, found by halving; NULL goes first."""
    if not cuts:
        return F.lit(0)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def z_value(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """Interleave the bits of the buckets, the first column's bit first."""
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(buckets):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(buckets) + len(buckets) - 1 - place))
    return z


def _write(df: DataFrame, output_path: str, rows_per_file: int | None) -> DataFrame:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file or 0).parquet(output_path)
    return df.sparkSession.read.schema(df.schema).parquet(output_path)
