"""Per-entity item-set summary."""

import hashlib

from likeness.operators import sets


def _h(x):
    return int(hashlib.md5(str(x).encode()).hexdigest()[:7], 16)


def test_item_sets_rows_vs_set_and_digest(spark):
    rows = [(1, 7), (1, 7), (1, 3)] + [(2, i) for i in range(20, 0, -1)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    out = {r["user_id"]: r for r in sets.item_sets(df).collect()}
    assert (out[1]["n_rows"], out[1]["n_items"]) == (3, 2)
    assert out[1]["items_digest"] == _h(7) + _h(3)
    assert out[1]["first_items"] == "3,7"
    assert out[2]["first_items"] == ",".join(str(i) for i in range(1, 11))
    # order-free: the digest does not depend on row order or partitioning
    again = {r["user_id"]: r["items_digest"] for r in sets.item_sets(df.repartition(5)).collect()}
    assert again == {u: r["items_digest"] for u, r in out.items()}


def test_audit_and_activity(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id long, item_id long")
    a = sets.audit(sets.item_sets(df)).collect()[0]
    assert (a["unique_users"], a["row_count"], a["null_lists"], a["ok"]) == (2, 2, 0, True)
    act = {r["user_id"]: r["n_rows"] for r in sets.activity(df, "user_id", 1).collect()}
    assert act == {1: 2}


def test_item_lists_hold_every_item(spark):
    rows = [(1, 7), (1, 7), (1, 3), (None, 5)] + [(2, i) for i in range(500, 0, -1)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").repartition(3)
    out = sets.item_lists(df, size=20).collect()
    assert [(r["chunk"], r["items"], r["times"]) for r in out if r["user_id"] == 1] == [(0, [3, 7], [1, 2])]
    two = [r for r in out if r["user_id"] == 2]
    assert len(two) > 20 and sorted(i for r in two for i in r["items"]) == list(range(1, 501))
    assert all(r["items"] == sorted(r["items"]) and len(r["items"]) < 50 for r in two)
    assert {r["user_id"] for r in out} == {1, 2}
