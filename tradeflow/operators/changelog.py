"""Keyed upserts with versions, as DataFrame operators over one partitioned Parquet table.

The log is one table partitioned by version. Each row is the full image of a changed row plus ``_version``,
``_operation`` ('insert' or 'update') and ``_committed_at``. Next to it, in ``_commits``, which Spark skips
when it reads the log, stands one row per commit, appended after the commit's rows: the version, its time, the
counts that the write job itself observed, the keys, and whether the version can still be read in full. A version
counts when its commit row is there; what a failed job has left is replaced by the next commit. Commits are
made by one writer at a time; commit times never decrease with the version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators.latest import key_hash, latest_per_key
from tradeflow.sources import tables

VERSION = "_version"
OPERATION = "_operation"
COMMITTED_AT = "_committed_at"
LOG_COLUMNS = (VERSION, OPERATION, COMMITTED_AT)
KEY_MARK = "tradeflow.key"
RETENTION_HOURS = 168.0
HISTORY_ROWS = 20
COMMITS = "_commits"
COMMIT_SCHEMA = f"{VERSION} bigint, {COMMITTED_AT} timestamp, rows bigint, inserted bigint, updated bigint, keys array<string>, readable boolean"
#: Up to so many keys of a batch are searched for in the scan itself, by each file's statistics and Bloom filters.
SCANNED_KEYS = 256

# A batch up to this size is sent to every executor, to read only its own keys from the log.
BROADCAST_KEYS = 500_000
BROADCAST_KEY_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class BatchSize:
    rows: int
    key_bytes: int

    def keys_fit_in_memory(self) -> bool:
        return self.rows <= BROADCAST_KEYS and self.key_bytes <= BROADCAST_KEY_BYTES


def check_batch(updates: DataFrame, keys: Sequence[str]) -> BatchSize:
    """Raise unless every row of the batch has a complete key of its own; return its size."""
    if not keys:
        raise ValueError("name at least one key column")
    missing = [k for k in keys if k not in updates.columns]
    if missing:
        raise ValueError(f"key columns not in the batch: {missing}")
    incomplete = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    length = F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys]))
    per_key = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = per_key.agg(
        F.coalesce(F.sum(F.when(incomplete, F.col("_n"))), F.lit(0)).alias("null_rows"),
        F.count_if(~incomplete & (F.col("_n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(length), F.lit(0)).alias("key_bytes"),
    ).first()
    if found["null_rows"] or found["repeated_keys"]:
        raise ValueError(
            f"batch has {found['null_rows']} rows with a NULL key and {found['repeated_keys']} repeated keys"
        )
    return BatchSize(found["rows"], found["key_bytes"])


def upsert(current: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``updates`` replaced or added; None is a table not yet there."""
    check_batch(updates, keys)
    if current is None:
        return updates
    _check_columns(current, updates)
    kept = current.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates)


def changes(current: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``updates`` that differ from ``current``, each with its operation.

    Rows are compared null-safe in every column, so a replayed batch yields no rows. Both sides have
    at most one row per key.
    """
    if current is None:
        return updates.withColumn(OPERATION, F.lit("insert"))
    _check_columns(current, updates)
    others = [c for c in updates.columns if c not in keys]
    before = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in others], F.lit(True).alias("_known"))
    same = F.lit(True)
    for c in others:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    operation = F.when(F.col("_known").isNull(), F.lit("insert")).when(~same, F.lit("update"))
    return (
        updates.join(before, list(keys), "left")
        .withColumn(OPERATION, operation)
        .filter(F.col(OPERATION).isNotNull())
        .select(*updates.columns, OPERATION)
    )


def append(
    spark: SparkSession,
    updates: DataFrame,
    log_path: str,
    keys: Sequence[str],
    committed_at: datetime | None = None,
) -> int | None:
    """Commit a batch and return the newest version, None while the log has no rows.

    The batch is read several times, so it should be stored rows and not a long computation.

    A version becomes visible with its commit row; a job that failed before that is replaced when the
    batch is sent again. A batch that changes nothing adds no version.
    """
    size = check_batch(updates, keys)
    stamp, version, current = committed_at or datetime.now(timezone.utc), 0, None
    last = _last_commit(spark, log_path)
    if last is not None:
        log = read_log(spark, log_path)
        if sorted(last["keys"]) != sorted(keys):
            raise ValueError(f"the log is keyed by {last['keys']}, not by {list(keys)}")
        _check_columns(log.drop(*LOG_COLUMNS), updates)
        version = last[VERSION] + 1
        current = as_of(only_keys_of(log, updates, keys, size), keys, last[VERSION])
    stamped = changes(current, updates, keys).withColumn(
        COMMITTED_AT, F.lit(stamp) if last is None else F.greatest(F.lit(stamp), F.lit(last[COMMITTED_AT]))
    )
    counted = Observation()
    rows = stamped.withColumn(VERSION, F.lit(version).cast("bigint")).observe(
        counted,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(OPERATION) == "insert").alias("inserted"),
        F.count_if(F.col(OPERATION) == "update").alias("updated"),
        F.max(COMMITTED_AT).alias("time"),
    )
    # Of a failed earlier attempt only the same version is replaced.
    _write_rows(rows.sortWithinPartitions(*keys), keys, log_path, "dynamic")
    found = counted.get
    if not found["rows"]:
        return None if last is None else last[VERSION]
    row = (version, found["time"], found["rows"], found["inserted"], found["updated"], list(keys), True)
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{log_path}/{COMMITS}")
    return version


def only_keys_of(log: DataFrame, batch: DataFrame, keys: Sequence[str], size: BatchSize) -> DataFrame:
    """The log's rows that the batch may replace, read by the cheapest way that the batch's size allows.

    A few keys become filters of the scan, which rules out row groups by their statistics and by the Bloom
    filters of the key column. More are sent to every executor. Beyond that the log is left whole.
    """
    if not size.keys_fit_in_memory():
        return log
    wanted = batch.select(*keys)
    if len(keys) == 1 and 0 < size.rows <= SCANNED_KEYS:
        same = [F.col(keys[0]) == F.lit(row[0]) for row in wanted.collect()]
        while len(same) > 1:
            same = [reduce(Column.__or__, same[k : k + 2]) for k in range(0, len(same), 2)]
        return log.filter(same[0])
    return log.join(F.broadcast(wanted), list(keys), "left_semi")


def _write_rows(rows: DataFrame, keys: Sequence[str], log_path: str, replaced: str) -> None:
    """Write rows by version, with a Bloom filter of each key column in every row group."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", replaced).partitionBy(VERSION)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(log_path)


merge_upsert = append


def commits(spark: SparkSession, log_path: str) -> DataFrame:
    """One row per commit; none while there is no log."""
    known = tables.read_if_present(spark, f"{log_path}/{COMMITS}")
    return spark.createDataFrame([], COMMIT_SCHEMA) if known is None else known


def _last_commit(spark: SparkSession, log_path: str):
    return commits(spark, log_path).agg(F.max_by(F.struct("*"), VERSION).alias("last")).first()["last"]


def versions(spark: SparkSession, log_path: str) -> list[int]:
    """Versions whose rows are there, oldest first."""
    return [row[0] for row in commits(spark, log_path).select(VERSION).orderBy(VERSION).collect()]


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All rows of committed versions."""
    log = tables.read(spark, log_path).withColumn(VERSION, F.col(VERSION).cast("bigint"))
    last = _last_commit(spark, log_path)
    return log.limit(0) if last is None else _mark_keys(log.filter(F.col(VERSION) <= last[VERSION]), last["keys"])


def is_log(spark: SparkSession, path: str) -> bool:
    return tables.read_if_present(spark, f"{path}/{COMMITS}") is not None


def key_columns(log: DataFrame) -> list[str]:
    return [field.name for field in log.schema.fields if field.metadata.get(KEY_MARK)]


def table_exists(spark: SparkSession, log_path: str) -> bool:
    return not commits(spark, log_path).isEmpty()


def as_of(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """The table at a version: the newest image per key up to it.

    The version bound prunes partitions, and each map task keeps one image per key, so keys that
    change often are not gathered. Version 0 has one image per key, as a batch repeats no key: nothing is ranked.
    """
    upto = log.filter(F.col(VERSION) <= version)
    if version == 0:
        return upto.drop(*LOG_COLUMNS)
    return latest_per_key(upto, keys, [F.col(VERSION).desc()]).drop(*LOG_COLUMNS)


def read_version(spark: SparkSession, log_path: str, version: int) -> DataFrame:
    """The table at a version; versions that retention has made incomplete are refused."""
    known = commits(spark, log_path).filter((F.col(VERSION) == version) & F.col("readable"))
    if known.isEmpty():
        newest = latest_version(spark, log_path)
        raise ValueError(f"version {version} is not readable; versions {oldest_complete(spark, log_path)} to {newest} are")
    log = read_log(spark, log_path)
    return as_of(log, key_columns(log), version)


def oldest_complete(spark: SparkSession, log_path: str) -> int:
    """The oldest version that can be read in full: 0 until retention has removed rows."""
    return commits(spark, log_path).filter("readable").agg(F.coalesce(F.min(VERSION), F.lit(0))).first()[0]


def newest_version(log: DataFrame) -> DataFrame:
    """One row from the log or its commits alike."""
    return log.agg(F.max(VERSION).alias("latest_version"))


def latest_version(spark: SparkSession, log_path: str) -> int | None:
    return newest_version(commits(spark, log_path)).first()[0]


def _summaries(log: DataFrame) -> DataFrame:
    return log.groupBy(VERSION, COMMITTED_AT).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(OPERATION) == "insert").alias("inserted"),
        F.count_if(F.col(OPERATION) == "update").alias("updated"),
    )


def history(log: DataFrame, limit: int = HISTORY_ROWS) -> DataFrame:
    """One row per commit, newest first."""
    return _summaries(log).orderBy(F.desc(VERSION)).limit(limit)


def table_history(spark: SparkSession, log_path: str, limit: int = HISTORY_ROWS) -> DataFrame:
    """The newest ``limit`` commits from their commit rows, also those whose rows retention has removed."""
    shown = commits(spark, log_path).select(VERSION, COMMITTED_AT, "rows", "inserted", "updated")
    return shown.orderBy(F.desc(VERSION)).limit(limit)


def expire(log: DataFrame, keys: Sequence[str], cutoff: datetime | Column) -> DataFrame:
    """The log without the images that had been replaced by the cutoff.

    Commit times follow versions. So what stays is every image committed after the cutoff, and of
    the older ones the newest per key: no key's images need to be brought together in order.
    """
    bound = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    recent = log.filter(F.col(COMMITTED_AT) > bound)
    older = log.filter(F.col(COMMITTED_AT) <= bound)
    return recent.unionByName(latest_per_key(older, keys, [F.col(VERSION).desc()]))


def vacuum_table(
    spark: SparkSession,
    log_path: str,
    output_path: str,
    retention_hours: float = RETENTION_HOURS,
) -> DataFrame:
    """Write the log without images replaced more than ``retention_hours`` ago to a new path."""
    return expire_log(spark, log_path, output_path, datetime.now(timezone.utc) - timedelta(hours=retention_hours))


def expire_log(spark: SparkSession, log_path: str, output_path: str, cutoff: datetime) -> DataFrame:
    """``vacuum_table`` with the cutoff itself; the new log keeps all commits and marks which are still complete."""
    log, known = read_log(spark, log_path), commits(spark, log_path)
    keys = key_columns(log)
    shown = F.coalesce(F.max(F.when(F.col(COMMITTED_AT) <= F.lit(cutoff), F.col(VERSION))), F.lit(0))
    complete = F.col("readable") & (F.col(VERSION) >= known.agg(shown).first()[0])
    return _rewrite(expire(log, keys, cutoff), keys, keys, known.withColumn("readable", complete), output_path)


def optimize_log(
    spark: SparkSession, log_path: str, output_path: str, sort_by: Sequence[str] | None = None
) -> DataFrame:
    """Rewrite a log with few files per version, its rows ordered by ``sort_by`` (else the keys).

    The result is a log again: later batches can be merged into it, and every version stays readable.
    """
    log = read_log(spark, log_path)
    keys = key_columns(log)
    order = list(sort_by or keys)
    missing = [c for c in order if c not in log.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return _rewrite(log, keys, order, commits(spark, log_path), output_path)


def _rewrite(log: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame, target: str) -> DataFrame:
    """Two writes whatever the number of versions: the rows, then the commits that make them count."""
    # Ranges keep the files per version few and still split a version that holds most rows.
    placed = log.repartitionByRange(F.col(VERSION), *[F.col(c) for c in order], key_hash(keys))
    _write_rows(placed.sortWithinPartitions(VERSION, *order), keys, target, "static")
    known.coalesce(1).write.mode("overwrite").parquet(f"{target}/{COMMITS}")
    return read_log(log.sparkSession, target)


def _mark_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.withMetadata(key, {KEY_MARK: True})
    return df


def _check_columns(current: DataFrame, updates: DataFrame) -> None:
    if sorted(current.columns) != sorted(updates.columns):
        raise ValueError(f"batch columns {updates.columns} differ from table columns {current.columns}")
    types = {f.name: f.dataType.simpleString() for f in current.schema.fields}
    other = {f.name: (types[f.name], f.dataType.simpleString()) for f in updates.schema.fields}
    other = {name: pair for name, pair in other.items() if pair[0] != pair[1]}
    if other:
        raise ValueError(f"batch columns of another type than the table's: {other}")
