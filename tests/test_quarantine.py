"""Quarantine with replay: a line is clean or rejected, once, and comes back."""

from __future__ import annotations

from martspark.streaming.quarantine import Quarantine

LINE = "invoice_number string, line_item_sequence int, component_sequence int, customer_id string, net_sales_amount double"


def _state(q):
    return (sorted((r.invoice_number, r.line_item_sequence) for r in q.clean().collect()),
            sorted((r.invoice_number, r.line_item_sequence, r.quarantine_reason) for r in q.rejects().collect()))


def test_rejected_lines_come_back(spark, tmp_path):
    q = Quarantine(spark, str(tmp_path / "q"), buckets=4)
    lines = spark.createDataFrame([("d1", 1, 0, "a", 1.0), ("d1", 2, 0, "a", None), ("d2", 1, 0, "b", 2.0), ("d3", 1, 0, None, 2.0),
                                   ("d4", 1, 0, "b", None)], LINE)
    only_a = spark.createDataFrame([("a",)], "customer_id string")
    both = spark.createDataFrame([("a",), ("b",), ("b",)], "customer_id string")
    assert q.replay(both) == []
    q.load(lines, only_a)
    unknown = "UNKNOWN_CUSTOMER"
    assert _state(q) == ([("d1", 1)], [("d1", 2, "NULL_AMOUNT"), ("d2", 1, unknown), ("d3", 1, unknown), ("d4", 1, unknown)])
    q.load(lines, only_a)  # delivered again: nothing changes
    assert len(_state(q)[0]) == 1 and len(_state(q)[1]) == 4
    q.load(spark.createDataFrame([("d1", 2, 0, "a", 9.0)], LINE), only_a)
    assert _state(q)[0] == [("d1", 1), ("d1", 2)]
    assert q.replay(only_a) == []
    assert q.replay(both)  # d2 is clean, d4 now lacks its amount only
    assert _state(q) == ([("d1", 1), ("d1", 2), ("d2", 1)], [("d3", 1, unknown), ("d4", 1, "NULL_AMOUNT")])
    q.load(spark.createDataFrame([("d4", 1, 0, "b", 1.0), ("d3", 1, 0, "a", 1.0)], LINE), both)
    assert _state(q) == ([("d1", 1), ("d1", 2), ("d2", 1), ("d3", 1), ("d4", 1)], [])
    assert q.counts().first() == (5, 0, 0)
