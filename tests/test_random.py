"""Random inputs against plain-Python models of what the operators promise."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from frames import ORDER, raw
from pyspark.sql import functions as F

from tradeflow.operators import changelog as c
from tradeflow.plans import validation as v
from tradeflow.sources.schemas import REASON

COLUMNS = list(ORDER)


def random_order(rng):
    return dict(
        order_id=rng.choice(["o1", "o1", "o1", "o2", "o3", "o4", None]),
        product_id=rng.choice(["p1", "p2", "p3", None]),
        channel=rng.choice(["web", "app", None]),
        quantity=rng.choice(["1", "2", "10", "0", "-1", "x", None]),
        unit_price=rng.choice(["5", "7.5", "0", "NaN", None]),
        ordered_at=rng.choice(["2026-07-01T00:00:00Z", "2026-07-02", "2026-07-01T02:00:00+02:00", "bad", None]),
    )


INSTANTS = {"2026-07-01T00:00:00Z": 1, "2026-07-01T02:00:00+02:00": 1, "2026-07-02": 2}


def reason_of(row):
    checks = [
        ("MISSING_ORDER_ID", row["order_id"] is None),
        ("MISSING_PRODUCT_ID", row["product_id"] is None),
        ("INVALID_QUANTITY", row["quantity"] in ("0", "-1", "x", None)),
        ("INVALID_PRICE", row["unit_price"] in ("0", "NaN", None)),
        ("INVALID_TIMESTAMP", row["ordered_at"] not in INSTANTS),
    ]
    return next((code for code, failed in checks if failed), None)


def model(table):
    """Multiset of (row, reason)."""
    out, groups = Counter(), defaultdict(list)
    for row in table:
        reason = reason_of(row)
        if reason:
            out[(*row.values(), reason)] += 1
        else:
            groups[row["order_id"]].append(row)
    for copies in groups.values():
        rest = ("product_id", "channel", "quantity", "unit_price", "ordered_at")
        copies.sort(
            key=lambda r: (INSTANTS[r["ordered_at"]], *[(r[k] is not None, r[k] or "") for k in rest]), reverse=True
        )
        for place, row in enumerate(copies):
            out[(*row.values(), "DUPLICATE_ORDER" if place else None)] += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_labels(spark, seed):
    rng = random.Random(seed)
    table = [random_order(rng) for _ in range(400)]
    frame = raw(spark, ORDER, *table).repartition(5)
    labelled = v.label(frame, v.ORDERS)
    expected = model(table)
    assert Counter(tuple(r) for r in labelled.select(*COLUMNS, REASON).collect()) == expected
    kept = Counter(tuple(r) for r in v.clean(frame, v.ORDERS).select("order_id", "product_id", "channel").collect())
    assert kept == Counter(key[:3] for key in expected.elements() if key[-1] is None)


@pytest.mark.parametrize("seed, bound", [(0, c.BROADCAST_KEYS), (1, 0)])
def test_change_log(spark, folder, monkeypatch, seed, bound):
    monkeypatch.setattr(c, "BROADCAST_KEYS", bound)
    rng, log, state, states, images = random.Random(seed), f"{folder}/log", {}, [], []
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for day in range(6):
        batch = {f"o{rng.randrange(8)}": rng.choice([1, 2, None]) for _ in range(rng.randrange(1, 7))}
        changed = {k: q for k, q in batch.items() if k not in state or state[k] != q}
        df = spark.createDataFrame(list(batch.items()), "order_id string, quantity long")
        version = c.append(spark, df, log, ["order_id"], start + timedelta(days=day))
        if changed:
            state = {**state, **changed}
            states.append(state)
            images += [(k, len(states) - 1, day) for k in changed]
        assert version == len(states) - 1
    for number, expected in enumerate(states):
        assert dict(map(tuple, c.read_version(spark, log, number).collect())) == expected
    cutoff = 3
    kept = {
        (k, n)
        for k, n, day in images
        if not any(k2 == k and n < n2 and day2 <= cutoff for k2, n2, day2 in images)
    }
    found = c.expire(c.read_log(spark, log), ["order_id"], start + timedelta(days=cutoff))
    assert {tuple(r) for r in found.select("order_id", F.col("_version")).collect()} == kept
