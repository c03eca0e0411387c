"""Rule states kept between runs equal an evaluation of the whole table."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from martspark.operators.quality import Rule, evaluate
from martspark.sources.parts import PartStore
from martspark.streaming.quality_state import QualityState

RULES = (Rule(1, "t", "row_count_between", (), "Completeness", {"min": 1, "max": 1000}), Rule(2, "t", "not_null", ("a",)),
         Rule(3, "t", "unique", ("b",)), Rule(4, "t", "compound_unique", ("a", "b")), Rule(5, "t", "in_set", ("c",), "x", {"values": (1, 2)}),
         Rule(6, "t", "between", ("c",), "x", {"min": 0, "max": 2}))


def test_states_are_merged_and_only_changed_parts_are_read(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    source = PartStore(spark, str(tmp_path / "t"))
    part = F.col("m").cast("string")
    state = QualityState(source, "t", part, RULES, str(tmp_path / "s"), buckets=4)

    def rows(months, n):
        got = [(m, rng.choice([None, 1, 2, 3]), rng.choice([None, *range(n)]), rng.choice([1, 1, 2, 3, None]))
               for m in months for _ in range(12)]
        return spark.createDataFrame(got, "m int, a int, b int, c int").withColumn("part", F.col("m").cast("string"))

    def check(read):
        seen = []
        with monkeypatch.context() as m:
            whole = PartStore.read
            m.setattr(PartStore, "read", lambda self, t, parts=None, **k: (self is source and seen.append(parts), whole(self, t, parts, **k))[1])
            assert state.run() == read
        assert seen == ([read] if read else [])
        got = sorted(map(tuple, state.results().collect()))
        assert got == sorted(map(tuple, evaluate({"t": source.read("t")}, RULES).collect()))

    assert state.run() == [] and [r.element_count for r in state.results().collect()] == [0] * 6
    change = source.change()
    change.append("t", rows([1, 2, 3], 30))
    change.publish()
    check(["1", "2", "3"])
    check([])  # an unchanged table: no file of it is read
    change = source.change()
    change.append("t", rows([3, 4], 60))
    change.publish()
    check(["3", "4"])
    change = source.change()
    change.replace("t", rows([2], 5), ["2"])  # corrected
    change.publish()
    check(["2"])
    change = source.change()
    change.replace("t", rows([], 1), ["1"])  # dropped
    change.publish()
    check([])
