"""Typed extracts, rejects and high-water marks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martspark.sources.binding import SOURCE_ORDER, Sources, materialize
from martspark.sources.extracts import ExtractLoader, column_bounds, typed
from martspark.sources.io import read_source
from martspark.sources.schemas import SOURCES

SMALL = "/root/testdata/sf0.001"


def _text(spark, **changes):
    names = SOURCES["MC00100"][2].fieldNames()
    rows = [{"EXGTBLID": "T", "CURNCYID": "USD", "EXCHDATE": "2020-01-02", "XCHGRATE": "4.5", "EXPNDATE": "2099-12-31", **c}
            for c in ([{}] + [{k: v} for k, v in changes.items()])]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_values_that_do_not_fit_reject_their_row(spark):
    rows, rejects = typed(_text(spark, EXCHDATE="2020-02-31", XCHGRATE="1.23456789", EXPNDATE=None, CURNCYID=None), "MC00100")
    assert rows.schema.simpleString() == SOURCES["MC00100"][2].simpleString()
    assert rows.count() == 3 and rows.first().EXCHDATE == dt.date(2020, 1, 2)
    assert sorted(r.reason for r in rejects.collect()) == ["EXCHDATE: not date", "XCHGRATE: not decimal(19,7)"]
    assert '"XCHGRATE":"1.23456789"' in "".join(r.row_json for r in rejects.collect())
    with pytest.raises(ValueError, match="lacks XCHGRATE"):
        typed(_text(spark).drop("XCHGRATE"), "MC00100")


def test_wider_types_are_narrowed_only_without_loss(spark):
    df = _text(spark).select("EXGTBLID", "CURNCYID", F.lit("2020-01-02 00:00:00").cast("timestamp").alias("EXCHDATE"),
                             F.explode(F.array(F.lit(1.5), F.lit(0.1), F.lit(1e300))).alias("XCHGRATE"), "EXPNDATE", F.lit(1).alias("more"))
    rows, rejects = typed(df, "MC00100")
    assert sorted(float(r.XCHGRATE) for r in rows.collect()) == [0.1, 1.5] and rejects.count() == 1
    late = df.withColumn("EXCHDATE", F.lit("2020-01-02 10:00:00").cast("timestamp"))
    assert typed(late, "MC00100").rows.count() == 0


def test_extracts_of_the_binding_are_read_in_the_registrys_types(spark, tmp_path):
    extracts = materialize(spark, SMALL, str(tmp_path))
    for name in SOURCE_ORDER:
        plain = read_source(spark, name, f"{tmp_path}/{name}")
        frame = extracts[name]
        assert frame.schema.simpleString() == SOURCES[name][2].simpleString()
        assert typed(plain, name).rejects.count() == 0 and frame.count() == plain.count() == Sources(spark, SMALL)[name].count()


def _rates(spark, *rows):
    return spark.createDataFrame([("T", "USD", d, r, "2099-12-31") for d, r in rows],
                                 "EXGTBLID string, CURNCYID string, EXCHDATE string, XCHGRATE string, EXPNDATE string")


def test_loads_go_on_from_the_high_water_mark(spark, tmp_path):
    loader = ExtractLoader(spark, str(tmp_path / "x"))
    first = [("2020-01-05", "1"), ("2020-02-03", "2"), ("2020-02-04", "bad")]
    assert loader.load("MC00100", _rates(spark, *first), "EXCHDATE") == ["202001", "202002"]
    assert loader.mark("MC00100") == dt.date(2020, 2, 1) and loader.table("MC00100").count() == 2
    more = [("2020-01-05", "99"), ("2020-02-03", "2"), ("2020-02-04", "3"), ("2020-03-09", "4"), ("no date", "5")]
    before = loader.store.state()["tables"]["MC00100"]["parts"]["202001"]
    assert loader.load("MC00100", _rates(spark, *more), "EXCHDATE") == ["202002", "202003"]  # January is behind the mark
    assert loader.store.state()["tables"]["MC00100"]["parts"]["202001"] == before
    assert sorted(float(r.XCHGRATE) for r in loader.table("MC00100").collect()) == [1, 2, 3, 4]
    assert [r.reason for r in loader.rejects().collect()] == ["EXCHDATE: not date"]  # the corrected row has left
    loader.load("MC00100", _rates(spark, *more), "EXCHDATE")
    assert loader.table("MC00100").count() == 4 and loader.rejects().count() == 1


def test_partition_bounds_come_from_the_data(spark):
    spark.range(5, 90).createOrReplaceTempView("bounded_rows")
    assert column_bounds(spark.sql, "bounded_rows", "id") == (5, 89)
    assert column_bounds(spark.sql, "(select * from bounded_rows where id < 0) x", "id") is None
