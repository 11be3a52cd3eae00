"""Schema drift at landing: the widening lattice, the policies, the audit."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import types as T

from unilake.sources.drift import AS_LANDED, RECONCILE, DriftPolicy, compare, widen

KINDS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2),
         T.DecimalType(38, 0), T.StringType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(),
         T.NullType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.IntegerType())]


def test_widen_is_a_join_of_types():
    for a, b in itertools.product(KINDS, repeat=2):
        assert widen(a, b) == widen(b, a)
        assert widen(a, a) == a and widen(a, T.NullType()) == a
        c = widen(a, b)
        if c is not None:   # the common type is above both
            assert widen(a, c) == c and widen(b, c) == c


@pytest.mark.parametrize("a, b, want", [
    ("int", "long", "bigint"), ("int", "double", "double"), ("int", "float", "double"), ("long", "double", None),
    ("long", "decimal(10,2)", "decimal(22,2)"), ("decimal(38,0)", "decimal(10,2)", None), ("date", "timestamp", "timestamp"),
    ("timestamp", "timestamp_ntz", None), ("string", "int", None), ("boolean", "int", None),
    ("struct<a:int>", "struct<A:long,b:string>", "struct<a:bigint,b:string>"), ("struct<a:int>", "struct<a:string>", None),
    ("array<int>", "array<string>", None), ("map<string,int>", "map<string,long>", "map<string,bigint>")])
def test_widen_cases(spark, a, b, want):
    parse = lambda t: spark.createDataFrame([], f"x {t}").schema["x"].dataType
    got = widen(parse(a), parse(b))
    assert (got and got.simpleString()) == want


def _land(lake, df, **options):
    lake.land("a", {"t": df}, **options)
    last = lake.audit().orderBy("load_id").collect()[-1]
    return last["status"], last["drift"]


def _v1(spark):
    return spark.createDataFrame([(1, "x", 5)], "id int, name string, qty long")


def _v2(spark):
    # extra: note; missing: name; widened: id; clash: qty
    return spark.createDataFrame([(1 << 40, "many", True)], "ID long, qty string, note boolean")


NOTES = "widened:ID int -> bigint; missing:name; clash:qty bigint -> string; extra:note"


def test_as_landed_reports_and_changes_nothing(spark, lake):
    assert _land(lake, _v1(spark)) == ("loaded", None)
    assert _land(lake, _v1(spark)) == ("loaded", None)
    assert _land(lake, _v2(spark)) == ("loaded", NOTES)
    assert lake.read_raw("raw_a__t").schema == _v2(spark).schema


def test_reconciled_types(spark, lake):
    _land(lake, _v1(spark))
    policy = DriftPolicy(missing="null", widened="widen", clash="text")
    assert _land(lake, _v2(spark), drift=policy) == ("loaded", NOTES)
    got = lake.read_raw("raw_a__t")
    assert got.dtypes == [("ID", "bigint"), ("name", "string"), ("qty", "string"), ("note", "boolean")]
    assert [tuple(r) for r in got.collect()] == [(1 << 40, None, "many", True)]
    # back to the first shape: narrower columns are cast up, nothing is lost
    assert _land(lake, _v1(spark), drift=policy) == (
        "loaded", "narrower:id bigint -> int; clash:qty string -> bigint; missing:note")
    assert [tuple(r) for r in lake.read_raw("raw_a__t").collect()] == [(1, "x", "5", None)]


@pytest.mark.parametrize("policy", [RECONCILE, DriftPolicy(extra="reject"), DriftPolicy(missing="reject"),
                                    DriftPolicy(widened="reject")])
def test_rejected_table_keeps_its_previous_load(spark, lake, policy):
    _land(lake, _v1(spark))
    res = lake.land("a", {"t": _v2(spark), "u": _v1(spark)}, drift=policy)
    assert res == {"raw.raw_a__u": 1}   # the load's other tables land
    rejected = lake.audit().where("status = 'rejected'").collect()
    assert [(r["raw_table"], r["row_count"], r["path"], r["drift"]) for r in rejected] == [("raw.raw_a__t", None, None, NOTES)]
    assert lake.read_raw("raw_a__t").schema == _v1(spark).schema
    assert lake.current_loads()["raw_a__t"][0] == 1


def test_declared_schema_and_repeated_names(spark, lake):
    contract = _v1(spark).schema
    drift = DriftPolicy(extra="drop", missing="null", widened="widen", clash="reject")
    lake.land_many({"a": {"t": spark.createDataFrame([(2, True)], "id int, note boolean")}}, drift=drift,
                   expected={"raw_a__t": contract})
    assert lake.read_raw("raw_a__t").schema == contract
    twice = spark.createDataFrame([(1, 2)], "a int, b int").toDF("x", "X")
    assert _land(lake, twice) == ("rejected", "repeated:x")
    assert compare(None, contract, AS_LANDED).notes == ()
    with pytest.raises(ValueError):
        DriftPolicy(extra="ignore")
