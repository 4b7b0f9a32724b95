import datetime as dt
import os

import pytest
from frames import plan, rows
from pyspark.sql import functions as F

from tradeflow.operators import changelog as c
from tradeflow.operators import layout

SCHEMA = "order_id string, product_id string, quantity long, unit_price double"


def batch(spark, **quantities):
    return spark.createDataFrame([(k, "p", q, 1.0) for k, q in quantities.items()], SCHEMA)


def state(df):
    return {r.order_id: r.quantity for r in df.collect()}


def test_upsert_replaces_and_inserts(spark, ansi):
    current = c.upsert(None, batch(spark, o1=1, o2=1), ["order_id"])
    merged = c.upsert(current, batch(spark, o1=9, o3=4), ["order_id"])
    assert state(merged) == dict(o1=9, o2=1, o3=4)
    assert rows(c.upsert(merged, batch(spark, o1=9, o3=4), ["order_id"])) == rows(merged)


def test_first_call_creates_and_replay_changes_nothing(spark, folder, ansi):
    log = f"{folder}/log"
    assert not c.table_exists(spark, log)
    for _ in range(3):
        assert c.merge_upsert(spark, batch(spark, o1=1, o2=2), log, ["order_id"]) == 0
    assert c.table_exists(spark, log)
    assert c.latest_version(spark, log) == 0
    assert state(c.read_version(spark, log, 0)) == dict(o1=1, o2=2)
    assert c.table_history(spark, log).count() == 1


def test_update_and_insert_in_one_batch(spark, folder):
    log = f"{folder}/log"
    c.merge_upsert(spark, batch(spark, o1=1, o2=1), log, ["order_id"])
    assert c.merge_upsert(spark, batch(spark, o1=9, o2=1, o3=4), log, ["order_id"]) == 1
    assert state(c.read_version(spark, log, 1)) == dict(o1=9, o2=1, o3=4)
    assert rows(c.table_history(spark, log), "_version", "rows", "inserted", "updated") == [
        (0, 2, 2, 0), (1, 2, 1, 1),
    ]


def test_old_versions_stay_readable(spark, folder):
    log = f"{folder}/log"
    c.merge_upsert(spark, batch(spark, o1=2), log, ["order_id"])
    c.merge_upsert(spark, batch(spark, o1=99), log, ["order_id"])
    assert state(c.read_version(spark, log, 0)) == dict(o1=2)
    assert state(c.read_version(spark, log, 1)) == dict(o1=99)
    for absent in (-1, 2):
        with pytest.raises(ValueError):
            c.read_version(spark, log, absent)


def test_null_values_are_compared(spark, folder):
    log = f"{folder}/log"
    c.merge_upsert(spark, batch(spark, o1=None), log, ["order_id"])
    assert c.merge_upsert(spark, batch(spark, o1=None), log, ["order_id"]) == 0
    assert c.merge_upsert(spark, batch(spark, o1=3), log, ["order_id"]) == 1
    assert c.merge_upsert(spark, batch(spark, o1=None), log, ["order_id"]) == 2


def test_several_key_columns(spark):
    current = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, l string, q long")
    updates = spark.createDataFrame([("a", "y", 5), ("b", "x", 6)], "k string, l string, q long")
    assert rows(c.upsert(current, updates, ["k", "l"])) == [("a", "x", 1), ("a", "y", 5), ("b", "x", 6)]


@pytest.mark.parametrize("keys", [[], ["nope"], ["order_id", "nope"]])
def test_bad_keys(spark, folder, keys):
    with pytest.raises(ValueError):
        c.upsert(None, batch(spark, o1=1), keys)
    with pytest.raises(ValueError):
        c.merge_upsert(spark, batch(spark, o1=1), f"{folder}/log", keys)


def test_repeated_and_null_keys_are_refused_on_every_call(spark, folder):
    log = f"{folder}/log"
    twice = batch(spark, o1=1).unionByName(batch(spark, o1=2))
    null = spark.createDataFrame([(None, "p", 1, 1.0)], SCHEMA)
    for bad in (twice, null):
        with pytest.raises(ValueError):
            c.merge_upsert(spark, bad, log, ["order_id"])
    c.merge_upsert(spark, batch(spark, o9=1), log, ["order_id"])
    for bad in (twice, null):
        with pytest.raises(ValueError):
            c.merge_upsert(spark, bad, log, ["order_id"])


def test_other_columns_are_refused(spark):
    with pytest.raises(ValueError):
        c.upsert(batch(spark, o1=1), batch(spark, o1=1).drop("unit_price"), ["order_id"])


def test_commit_times_never_decrease(spark, folder):
    log = f"{folder}/log"
    late, early = (dt.datetime(2026, 1, d, tzinfo=dt.timezone.utc) for d in (5, 1))
    c.append(spark, batch(spark, o1=1), log, ["order_id"], late)
    c.append(spark, batch(spark, o1=2), log, ["order_id"], early)
    times = [r[0] for r in c.read_log(spark, log).select("_committed_at").distinct().collect()]
    assert len(times) == 1


def test_history_is_newest_first_and_limited(spark, folder):
    log = f"{folder}/log"
    for q in range(3):
        c.append(spark, batch(spark, o1=q), log, ["order_id"])
    assert [r["_version"] for r in c.table_history(spark, log, 2).collect()] == [2, 1]


def test_expire_keeps_what_the_cutoff_still_showed(spark, folder):
    log, days = f"{folder}/log", [dt.datetime(2026, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2, 3, 10)]
    for q, day in enumerate(days):
        c.append(spark, batch(spark, o1=q, o2=7), log, ["order_id"], day)
    kept = c.expire(c.read_log(spark, log), ["order_id"], dt.datetime(2026, 1, 5, tzinfo=dt.timezone.utc))
    assert rows(kept, "order_id", "_version") == [("o1", 2), ("o1", 3), ("o2", 0)]
    assert state(c.as_of(kept, ["order_id"], 3)) == dict(o1=3, o2=7)


def test_vacuum_writes_a_smaller_log_with_the_same_state(spark, folder):
    log = f"{folder}/log"
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    for q in range(3):
        c.append(spark, batch(spark, o1=q, o2=1), log, ["order_id"], old)
    kept = c.vacuum_table(spark, log, f"{folder}/kept")
    assert rows(kept, "order_id", "_version", "quantity") == [("o1", 2, 2), ("o2", 0, 1)]
    assert state(c.read_version(spark, f"{folder}/kept", 2)) == dict(o1=2, o2=1)
    assert c.merge_upsert(spark, batch(spark, o3=1), f"{folder}/kept", ["order_id"]) == 3
    fresh = c.vacuum_table(spark, log, f"{folder}/all", retention_hours=24 * 365 * 100)
    assert fresh.count() == c.read_log(spark, log).count()


def test_versions_prune_partitions_and_images_are_cut_in_the_map_tasks(spark, folder):
    log = f"{folder}/log"
    c.append(spark, batch(spark, o1=1), log, ["order_id"])
    text = plan(c.as_of(c.read_log(spark, log), ["order_id"], 0)).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(_version" in text
    assert text.count("WindowGroupLimit") == 2


def test_batches_beyond_the_broadcast_bound_give_the_same_log(spark, folder, monkeypatch):
    for bound in (c.BROADCAST_KEYS, 0):
        monkeypatch.setattr(c, "BROADCAST_KEYS", bound)
        log = f"{folder}/log{bound}"
        c.append(spark, batch(spark, o1=1, o2=1, o3=1), log, ["order_id"])
        c.append(spark, batch(spark, o2=5, o3=1, o4=2), log, ["order_id"])
        columns = ("order_id", "quantity", "_version", "_operation")
        assert rows(c.read_log(spark, log), *columns) == [
            ("o1", 1, 0, "insert"), ("o2", 1, 0, "insert"), ("o2", 5, 1, "update"),
            ("o3", 1, 0, "insert"), ("o4", 2, 1, "insert"),
        ]


def test_batch_size(spark):
    size = c.check_batch(batch(spark, o1=1, o22=1), ["order_id"])
    assert (size.rows, size.key_bytes) == (2, 5) and size.keys_fit_in_memory()


def test_a_log_keeps_its_keys(spark, folder):
    log = f"{folder}/log"
    two = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, l string, q long")
    c.merge_upsert(spark, two, log, ["k", "l"])
    c.merge_upsert(spark, two.filter("l = 'y'").withColumn("q", two.q + 1), log, ["l", "k"])
    assert c.key_columns(c.read_log(spark, log)) == ["k", "l"]
    assert rows(c.read_version(spark, log, 1)) == [("a", "x", 1), ("a", "y", 3)]
    with pytest.raises(ValueError, match="keyed by"):
        c.merge_upsert(spark, two.limit(1), log, ["k"])


@pytest.mark.parametrize("zorder_by", [None, ["product_id", "quantity"]])
def test_upsert_after_optimize_keeps_every_row(spark, folder, zorder_by):
    log, out = f"{folder}/log", f"{folder}/out"
    for k in range(3):
        c.merge_upsert(spark, batch(spark, **{f"o{k}": k}), log, ["order_id"])
    layout.optimize_table(spark, log, out, zorder_by)
    assert c.merge_upsert(spark, batch(spark, o9=9, o1=5), out, ["order_id"]) == 3
    assert state(c.read_version(spark, out, 3)) == dict(o0=0, o1=5, o2=2, o9=9)
    assert state(c.read_version(spark, out, 1)) == dict(o0=0, o1=1)
    with pytest.raises(ValueError, match="change log"):
        layout.compact(spark, log, f"{folder}/flat")


def test_versions_below_the_horizon_are_refused_and_history_stays(spark, folder):
    log, short = f"{folder}/log", f"{folder}/short"
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    for q in range(3):
        c.append(spark, batch(spark, o1=q, o2=1), log, ["order_id"], old)
    before = rows(c.table_history(spark, log))
    c.vacuum_table(spark, log, short)
    assert c.oldest_complete(spark, short) == 2
    for version in (0, 1, 3):
        with pytest.raises(ValueError, match="not readable"):
            c.read_version(spark, short, version)
    assert state(c.read_version(spark, short, 2)) == dict(o1=2, o2=1)
    assert rows(c.table_history(spark, short)) == before


def test_a_batch_of_another_type_is_refused_before_anything_is_written(spark, folder):
    log = f"{folder}/log"
    c.merge_upsert(spark, batch(spark, o1=1), log, ["order_id"])
    wrong = batch(spark, o1=2).withColumn("quantity", F.col("quantity").cast("double"))
    with pytest.raises(ValueError, match="another type"):
        c.merge_upsert(spark, wrong, log, ["order_id"])
    assert c.versions(spark, log) == [0] and state(c.read_version(spark, log, 0)) == dict(o1=1)


def test_what_a_failed_job_left_is_neither_read_nor_numbered(spark, folder):
    log = f"{folder}/log"
    c.merge_upsert(spark, batch(spark, o1=1), log, ["order_id"])
    left = c.read_log(spark, log).drop("_version").withColumn("quantity", F.lit(77).cast("long"))
    left.write.parquet(f"{log}/_version=1")
    os.remove(f"{log}/_version=1/_SUCCESS")
    assert c.latest_version(spark, log) == 0 and c.read_log(spark, log).count() == 1
    assert c.merge_upsert(spark, batch(spark, o2=2), log, ["order_id"]) == 1
    assert state(c.read_version(spark, log, 1)) == dict(o1=1, o2=2)


def scanned_rows(df):
    """Rows that the scans of a frame handed on after skipping row groups."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_small_batch_reads_few_row_groups_of_a_log_with_many(spark, folder):
    """Keys are spread over the whole range in every file, so only Bloom filters can tell them apart."""
    log = f"{folder}/log"
    for k in range(12):
        ids = spark.range(5_000).select(F.sha2(F.concat(F.lit(f"{k}/"), F.col("id").cast("string")), 256).alias("order_id"), F.lit("p").alias("product_id"), "id", F.lit(1.0).alias("unit_price"))
        c.append(spark, ids.withColumnRenamed("id", "quantity").coalesce(1), log, ["order_id"])
    table = c.read_log(spark, log)
    one = table.filter("quantity = 17 AND _version = 5").drop(*c.LOG_COLUMNS).withColumn("quantity", F.lit(-1).cast("long"))
    found = c.only_keys_of(table, one, ["order_id"], c.check_batch(one, ["order_id"]))
    assert found.count() == 1 and table.count() == 60_000
    assert scanned_rows(found) <= 2 * 5_000
    assert c.append(spark, one, log, ["order_id"]) == 12
    assert c.read_version(spark, log, 12).filter("quantity = -1").count() == 1 and c.read_version(spark, log, 12).count() == 60_000


def test_every_way_of_finding_a_batch_gives_the_same_log(spark, folder, monkeypatch):
    for scanned, sent in ((256, 1000), (0, 1000), (0, 0)):
        monkeypatch.setattr(c, "SCANNED_KEYS", scanned)
        monkeypatch.setattr(c, "BROADCAST_KEYS", sent)
        log = f"{folder}/log-{scanned}-{sent}"
        c.append(spark, batch(spark, **{f"o{k}": k for k in range(20)}), log, ["order_id"])
        c.append(spark, batch(spark, **{f"o{k}": k % 2 for k in range(15, 25)}), log, ["order_id"])
        assert state(c.read_version(spark, log, 1)) == {f"o{k}": k % 2 if k >= 15 else k for k in range(25)}


def test_commit_counts_are_those_of_the_written_rows(spark, folder):
    log = f"{folder}/log"
    for changed in (dict(o1=1, o2=2), dict(o2=3, o3=4), dict(o2=3)):
        c.append(spark, batch(spark, **changed), log, ["order_id"])
    assert rows(c.table_history(spark, log)) == rows(c.history(c.read_log(spark, log)))
    assert c.versions(spark, log) == [0, 1]


def test_the_first_version_is_read_without_ranking(spark, folder):
    c.append(spark, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long"), folder + "/log", ["k"])
    c.append(spark, spark.createDataFrame([("a", 3)], "k string, v long"), folder + "/log", ["k"])
    log = c.read_log(spark, folder + "/log")
    first, second = (c.as_of(log, ["k"], version) for version in (0, 1))
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 2)] and sorted(map(tuple, second.collect())) == [("a", 3), ("b", 2)]
    exchanges = [df._jdf.queryExecution().toString().count("Exchange") for df in (first, second)]
    assert exchanges[0] == 0 < exchanges[1]
