import re

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradeflow.session import shared_folder
from tradeflow.sources import raw, tables
from tradeflow.sources.schemas import CORRUPT, INGESTED_AT, RAW_ORDERS, SOURCE_FILE


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as file:
        file.write(text)
    return path


def test_orders_keep_every_value_as_text(spark, folder):
    source = write(
        folder,
        "orders.jsonl",
        '{"order_id": "o1", "quantity": 2, "unit_price": 1.50, "channel": true, "extra_field": {"a": 1}}\n'
        '{"order_id": "o2", "quantity": "abc", "unknown": 5}\n'
        "not json\n",
    )
    table = raw.ingest_orders(spark, source, f"{folder}/raw")
    columns = ("order_id", "quantity", "unit_price", "channel", "extra_field", CORRUPT)
    assert rows(table, *columns) == [
        ("o1", "2", "1.50", "true", '{"a": 1}', None),
        ("o2", "abc", None, None, None, None),
        (None, None, None, None, None, "not json"),
    ]
    assert "unknown" not in table.columns
    assert set(dict(table.dtypes).values()) == {"string"}


def test_provenance_is_one_instant_and_the_given_path(spark, folder):
    source = write(folder, "p.jsonl", '{"product_id": "p"}\n{"product_id": "q"}\n')
    table = raw.ingest_price_events(spark, source, f"{folder}/raw")
    ((instant, path),) = {(r[INGESTED_AT], r[SOURCE_FILE]) for r in table.collect()}
    assert path == source and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z", instant)


def test_provenance_per_file(spark, folder):
    for name in ("a.jsonl", "b.jsonl"):
        write(folder, name, '{"order_id": "%s"}\n' % name)
    table = raw.ingest_orders(spark, f"{folder}/*.jsonl", f"{folder}/raw", per_file=True)
    assert all(r[SOURCE_FILE].endswith("/" + r.order_id) for r in table.collect())


def test_csv_rows_of_other_lengths(spark, folder):
    source = write(
        folder,
        "stock.csv",
        "product_id,warehouse,quantity,updated_at\np1,w1,5,2026-07-01T00:00:00Z\np2,w2\np3,,,t,surplus\n",
    )
    table = raw.ingest_inventory(spark, source, f"{folder}/raw")
    assert rows(table, "product_id", "warehouse", "quantity", "updated_at", CORRUPT) == [
        ("p1", "w1", "5", "2026-07-01T00:00:00Z", None),
        ("p2", "w2", None, None, "p2,w2"),
        ("p3", None, None, "t", "p3,,,t,surplus"),
    ]


def test_reordered_csv_header_fails(spark, folder):
    source = write(folder, "stock.csv", "warehouse,product_id,quantity,updated_at\nw1,p1,5,2026-07-01T00:00:00Z\n")
    with pytest.raises(Exception, match="header"):
        raw.ingest_inventory(spark, source, f"{folder}/raw")


def test_ingest_replaces_the_table(spark, folder):
    first = write(folder, "1.jsonl", '{"order_id": "a"}\n{"order_id": "b"}\n')
    second = write(folder, "2.jsonl", '{"order_id": "c"}\n')
    raw.ingest_orders(spark, first, f"{folder}/raw")
    table = raw.ingest_orders(spark, second, f"{folder}/raw")
    assert rows(table, "order_id") == [("c",)]


def test_schemas_are_not_changed_by_reading(spark, folder):
    source = write(folder, "o.jsonl", '{"order_id": "a"}\n')
    for _ in range(2):
        raw.read_json_lines(spark, source, RAW_ORDERS).collect()
    assert CORRUPT not in RAW_ORDERS.fieldNames()


def test_missing_table_is_empty_with_its_schema(spark, folder):
    table = tables.read_or_empty(spark, f"{folder}/absent", RAW_ORDERS)
    assert table.schema == RAW_ORDERS and table.isEmpty()
    tables.overwrite(spark.range(3).select(F.col("id")), f"{folder}/there")
    assert tables.read_or_empty(spark, f"{folder}/there", RAW_ORDERS).count() == 3


def test_shared_folder_follows_the_session(spark):
    first, second = shared_folder(spark), shared_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(base) and second.startswith(base)


def test_a_file_manifest_counts_every_line_once(spark, folder):
    write(folder, "a.jsonl", '{"order_id": "a"}\n{"order_id": "b"}\nnot json\n')
    write(folder, "b.jsonl", "[1\n")
    write(folder, "empty.jsonl", "")
    found = raw.file_manifest(raw.read_json_lines(spark, f"{folder}/*.jsonl", RAW_ORDERS)).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.bytes, r.rows, r.parsed_rows, r.corrupt_rows, r.blank_rows) for r in found) == [("a.jsonl", 45, 3, 2, 1, 1), ("b.jsonl", 3, 1, 0, 1, 1)]
    assert all(r.modified_at is not None for r in found)
