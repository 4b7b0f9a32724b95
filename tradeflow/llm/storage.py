"""Intermediate tables of one operator, in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradeflow.session import shared_folder


class Store:
    """Parquet tables below one new shared folder.

    Writing a table cuts the lineage: a lost executor repeats only what reads it. Tables that later
    steps replace are dropped at once; the others stay until the caller removes the folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = small_batches(spark)
        self.base = shared_folder(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        # The schema is known, so no job has to open the files for it.
        return self.spark.read.schema(_nullable(df.schema)).parquet(path)

    @contextmanager
    def settings(self, wanted: Mapping[str, str]) -> Iterator[None]:
        """Settings of the session that hold for the tables written meanwhile."""
        before = {key: self.spark.conf.get(key, None) for key in wanted}
        try:
            for key, value in wanted.items():
                self.spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


#: Bytes of a batch that Spark hands to Python, at most; one longer row is a batch of its own.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand texts to Python a few megabytes at a time: a batch is held twice on either side of the pipe.

    The setting stays; it bounds memory and changes no result.
    """
    spark.conf.set(*BATCH_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
