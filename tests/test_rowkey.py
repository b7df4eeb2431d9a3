"""Row keys tell rows apart that differ anywhere."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime

from pyspark.sql import functions as F

from parcelgrid.operators.keys import ROW_KEY, with_row_key


def test_keys_of_near_equal_rows_differ(spark):
    def at(micro):
        return datetime(2024, 1, 1, 0, 0, 0, micro)

    rows = [
        (at(1), [at(1)], {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(2), [at(1)], {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [at(2)], {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(2)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(1)}, (at(2), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(1)}, (at(1), "a"), b"\x01", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(1)}, (at(1), "a"), b"\x00", [["a", "b"], []]),
        (None, [at(1)], {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), None, {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [None], {"k": at(1)}, (at(1), "a"), b"\x00", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(1)}, None, b"\x00", [["a"], ["b"]]),
        (at(1), [at(1)], {"k": at(1)}, (at(1), "a"), None, [["a"], ["b"]]),
    ]
    frame = spark.createDataFrame(
        rows + rows[:1],
        "t timestamp, a array<timestamp>, m map<string,timestamp>, s struct<t:timestamp,x:string>,"
        " b binary, n array<array<string>>",
    )
    keys = [tuple(r) for r in with_row_key(frame, frame.columns).select(*ROW_KEY).collect()]
    assert len(set(keys)) == len(rows) and keys[0] == keys[-1]


def _keys(frame):
    return [tuple(r) for r in with_row_key(frame, frame.columns).select(*ROW_KEY).collect()]


def test_an_hour_that_comes_twice_is_two_hours(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hours = spark.range(2).select(F.timestamp_seconds(F.lit(1_730_611_800) + F.col("id") * 3600).alias("t"))
        hours = hours.select("t", F.array("t").alias("a"), F.create_map(F.lit("k"), "t").alias("m"), F.struct("t").alias("s"))
        assert hours.select(F.col("t").cast("string")).distinct().count() == 1
        for column in hours.columns:
            assert len(set(_keys(hours.select(column)))) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_both_zeros_and_all_nans_are_one(spark):
    frame = spark.createDataFrame(
        [(0.0, [0.0], (0.0,)), (-0.0, [-0.0], (-0.0,)), (float("nan"), [float("nan")], (float("nan"),))],
        "d double, a array<double>, s struct<d:double>",
    )
    same = frame.select(F.col("d") / 1, "a", "s").union(frame.select(F.sqrt(F.lit(-1.0)) * F.col("d"), "a", "s"))
    zero, minus, nan, *others = _keys(same)
    assert zero == minus != nan and others[2] == nan


def test_what_stands_where_matters(spark):
    """Lists that would be alike if laid end to end."""
    rows = [
        ([0], [], [[0], []], {"a": 0}), ([], [0], [[], [0]], {"a": 0}), ([None], [], [[0], []], {"a": 0}),
        ([0], [], [[0], None], {"a": 0}), ([0], [], [[0]], {"a": 0}), ([0], [], [[0], []], {}), ([0], [], [[0], []], {"a": None}),
        ([0], None, [[0], []], {"a": 0}), (None, [0], [[0], []], {"a": 0}), ([0, None], [], [[0], []], {"a": 0}),
        ([None, 0], [], [[0], []], {"a": 0}), ([0], [], [[None], []], {"a": 0}), ([0], [], [[], [None]], {"a": 0}),
    ]
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, n array<array<long>>, m map<string,long>")
    assert len(set(_keys(frame))) == len(rows)
    turned = spark.range(2).select(F.expr("if(id = 0, map('a', 1, 'b', 2), map('b', 2, 'a', 1)) AS m"))
    assert len(set(_keys(turned))) == 1


def test_keys_group_as_spark_does(spark):
    choices = ["NULL", "array()", "array(NULL)", "array(0e0)", "array(-0e0)", "array(0e0, NULL)", "array(cast('NaN' AS double))"]
    values = " UNION ALL ".join(f"SELECT cast({a} AS array<double>) AS a, cast({b} AS array<double>) AS b" for a in choices for b in choices)
    frame = spark.sql(values)
    keyed = with_row_key(frame, ["a", "b"])
    assert keyed.select(*ROW_KEY).distinct().count() == frame.distinct().count()
    groups = defaultdict(set)
    for r in keyed.collect():
        groups[r[-2], r[-1]].add(str(([x and x or 0.0 if x is not None else None for x in r.a] if r.a is not None else None, [x and x or 0.0 if x is not None else None for x in r.b] if r.b is not None else None)))
    assert all(len(g) == 1 for g in groups.values())
