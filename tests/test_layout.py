import decimal
import glob
import os

import pyarrow.parquet as pq
import pytest
from frames import plan, rows
from pyspark.sql import functions as F

from tradeflow.operators import layout


def files(path):
    return sorted(glob.glob(f"{path}/*.parquet"))


@pytest.fixture
def scattered(spark, folder):
    """20,000 rows in 12 files with no order in any column."""
    table = spark.range(20_000).select(
        "id",
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.concat(F.lit("SKU-"), F.lpad(F.pmod(F.hash("id"), F.lit(1000)).cast("string"), 4, "0")).alias("b"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.rand(1)).alias("c"),
    )
    table.repartition(12).write.parquet(f"{folder}/in")
    return f"{folder}/in"


def test_compact_joins_small_files(spark, scattered, folder):
    out = layout.compact(spark, scattered, f"{folder}/out", rows_per_file=10_000)
    assert rows(out) == rows(spark.read.parquet(scattered))
    assert len(files(scattered)) == 12 and len(files(f"{folder}/out")) <= 3


def test_compact_splits_a_large_file(spark, folder):
    spark.range(1000).coalesce(1).write.parquet(f"{folder}/in")
    out = layout.compact(spark, f"{folder}/in", f"{folder}/out", rows_per_file=100)
    assert out.count() == 1000
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files(f"{folder}/out")]
    assert max(sizes) <= 100


def test_compact_does_not_shuffle_to_merge(spark, scattered, folder, monkeypatch):
    seen = []
    write = layout._write
    monkeypatch.setattr(layout, "_write", lambda df, *rest: seen.append(plan(df)) or write(df, *rest))
    layout.compact(spark, scattered, f"{folder}/out", rows_per_file=10_000)
    assert "Coalesce" in seen[0] and "Exchange" not in seen[0]


def test_files_are_sized_by_bytes(spark, folder):
    wide = spark.range(2000).select("id", F.concat(*[F.sha2(F.concat("id", F.lit(k)).cast("string"), 512) for k in range(16)]).alias("text"))
    wide.coalesce(1).write.parquet(f"{folder}/in")
    layout.compact(spark, f"{folder}/in", f"{folder}/out", bytes_per_file=1 << 20)
    sizes = [os.path.getsize(f) for f in files(f"{folder}/out")]
    assert len(sizes) > 1 and max(sizes) < 2 << 20


def overlapping(paths, column, value):
    """Files whose statistics do not rule the value out."""
    hits = 0
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        index = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(index).statistics for g in range(meta.num_row_groups)]
        hits += any(s.min <= value <= s.max for s in stats)
    return hits


def test_clustering_lets_filters_on_either_column_skip_files(spark, scattered, folder):
    out = layout.cluster(spark, scattered, f"{folder}/out", ["a", "b"], rows_per_file=1250)
    assert rows(out) == rows(spark.read.parquet(scattered))
    after, before = files(f"{folder}/out"), files(scattered)
    assert overlapping(before, "a", 500) == len(before)
    for column, value in (("a", 500), ("b", "SKU-0500")):
        assert overlapping(after, column, value) <= len(after) / 2


def test_clustering_keeps_nulls_and_splits_equal_rows(spark, folder):
    spark.range(4000).select(F.lit(None).cast("double").alias("x"), F.lit("same").alias("y")).write.parquet(
        f"{folder}/in"
    )
    out = layout.cluster(spark, f"{folder}/in", f"{folder}/out", ["x", "y"], rows_per_file=1000)
    assert out.count() == 4000 and out.filter("x IS NULL AND y = 'same'").count() == 4000
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files(f"{folder}/out")]
    assert len(sizes) >= 4 and max(sizes) <= 1000


def test_bucket_counts_cut_points_at_or_below(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (7,), (9,), (100,)], "v long")
    found = df.select(layout.bucket(F.col("v"), [5, 7, 9]).alias("b")).collect()
    assert [r.b for r in found] == [0, 0, 1, 2, 3, 3]


def test_z_value_interleaves_bits(spark):
    z = layout.z_value([F.lit(0b101), F.lit(0b011)], bits=3)
    assert spark.range(1).select(z).first()[0] == 0b100111


@pytest.mark.parametrize("columns", [[], ["absent"]])
def test_unknown_columns(spark, scattered, folder, columns):
    with pytest.raises(ValueError):
        layout.cluster(spark, scattered, f"{folder}/out", columns)


def test_optimize_keeps_rows(spark, scattered, folder):
    before = rows(spark.read.parquet(scattered))
    assert rows(layout.optimize_table(spark, scattered, f"{folder}/one")) == before
    assert rows(layout.optimize_table(spark, scattered, f"{folder}/two", zorder_by=["a"])) == before


def test_cut_points_split_a_skewed_column_evenly(spark):
    """Values that crowd at one end, and texts that differ only after a long common start."""
    n = F.col("id")
    skewed = spark.range(20_000).select(F.exp(n / 1500.0).alias("x"), F.format_string("warehouse-north-%08d", n * n).alias("y"))
    places = {c: layout.place_of(skewed, c) for c in ("x", "y")}
    cuts = layout.cut_points(skewed, places, bits=4)
    for column, place in places.items():
        assert len(cuts[column]) == 15
        sizes = [r["count"] for r in skewed.groupBy(layout.bucket(place, cuts[column]).alias("b")).count().collect()]
        assert len(sizes) == 16 and max(sizes) <= 2 * min(sizes)


def test_places_follow_the_order_of_values(spark):
    import datetime as dt

    values = [
        ("double", [float("-inf"), -1.5, 0.0, 2.0, float("inf")]),
        ("string", ["", "SKU", "SKU-1", "SKU-10", "SKU-2", "SKV", "\u00e9"]),
        ("boolean", [False, True]),
        ("date", [dt.date(1969, 1, 1), dt.date(2026, 1, 1)]),
        ("timestamp_ntz", [dt.datetime(1969, 1, 1), dt.datetime(2026, 1, 1, 0, 0, 0, 1)]),
        ("decimal(9,2)", [decimal.Decimal("-1.50"), decimal.Decimal("3.25")]),
    ]
    for kind, known in values:
        df = spark.createDataFrame([(k, v) for k, v in enumerate([*known, None])], f"k int, v {kind}")
        found = [r.p for r in df.select("k", layout.place_of(df, "v").alias("p")).orderBy("k").collect()]
        assert found[-1] is None and found[:-1] == sorted(found[:-1]) and (kind == "string" or len(set(found)) == len(found)), kind
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert layout.cut_points(nan, {"v": layout.place_of(nan, "v")}, 2) == {"v": [1.0]}
    none = nan.limit(0)
    assert layout.cut_points(none, {"v": layout.place_of(none, "v")}, 2) == {"v": []}


def test_no_task_of_a_compaction_copies_more_than_a_split(spark, scattered, folder, monkeypatch):
    """A table of 2 GiB by its listing is copied by 16 tasks, not by 2."""
    seen = []
    monkeypatch.setattr(layout.tables, "stored_bytes", lambda *_: 2 << 30)
    monkeypatch.setattr(layout, "_write", lambda df, *_: seen.append(df.rdd.getNumPartitions()))
    layout.compact(spark, scattered, f"{folder}/out")
    assert seen == [16]


def test_clustered_files_are_sized_by_decoded_rows(spark, folder, monkeypatch):
    """Texts that compress to nothing still have to be sorted: 16 MB of them take 16 files of 1 MB."""
    monkeypatch.setattr(layout, "SORTED_BYTES", 1 << 20)
    spark.range(4000).select("id", F.repeat(F.lit("x"), 4096).alias("text"), F.array("id").alias("list")).write.parquet(f"{folder}/in")
    out = layout.cluster(spark, f"{folder}/in", f"{folder}/out", ["id"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files(f"{folder}/out")]
    assert out.count() == 4000 and len(sizes) >= 16 and max(sizes) <= 500
