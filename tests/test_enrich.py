"""Grading rules, enrichment rows and totals."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from parcelgrid.functions import classify_parcel
from parcelgrid.operators import enrich, ensure_point_id, summary
from parcelgrid.operators.enrich import OUTPUT_COLUMNS
from parcelgrid.sources import tracts_from_wkt
from parcelgrid.types import PARCEL_ATTRS

NONE = (False, "high", ["no truck signal"])

CASES = {
    "name with apostrophe": ({"owner": "Love's"}, (True, "medium", ["keyword: 'Love's'"])),
    "whole words only": ({"owner": "UPSTATE FARM"}, NONE),
    "across two fields": (
        {"owner": "ACME TRUCK", "address": "STOP RD"},
        (True, "medium", ["keyword: 'TRUCK STOP'"]),
    ),
    "open end": ({"address": "1 Warehousing Way"}, (True, "medium", ["keyword: 'Warehous'"])),
    "first in the text": ({"owner": "UPS FREIGHT"}, (True, "medium", ["keyword: 'UPS'"])),
    "raw zoning": ({"zoning_type": " Industrial "}, (True, "medium", ["zoning:  Industrial "])),
    "no-break space": ({"zoning_type": " warehouse\t"}, (True, "medium", ["zoning:  warehouse\t"])),
    "zoning and code": (
        {"zoning_type": "Manufacturing", "lbcs_function": "4100"},
        (True, "high", ["zoning: Manufacturing", "lbcs_function=4100"]),
    ),
    "keyword and code": (
        {"struct": "PILOT", "lbcs_activity": "3000"},
        (True, "high", ["keyword: 'PILOT'", "lbcs_activity=3000"]),
    ),
    "keyword and zoning": (
        {"owner": "fedex", "zoning_type": "WAREHOUSE"},
        (True, "high", ["keyword: 'fedex'", "zoning: WAREHOUSE"]),
    ),
    "first code only": (
        {"lbcs_activity": "4999", "lbcs_function": "3000"},
        (True, "medium", ["lbcs_activity=4999"]),
    ),
    "second code": (
        {"lbcs_activity": "1100", "lbcs_function": "3999.5"},
        (True, "medium", ["lbcs_function=3999.5"]),
    ),
    **{
        f"code {code!r}": ({"lbcs_activity": code}, NONE)
        for code in ("2999", "5000", "39.5", "abc", " ", "", "+399", "3_99", "399")
    },
    "weak word": (
        {"zoning_subtype": "Special Commercial", "owner": "GAS PLAZA"},
        (True, "low", ["special commercial + weak keyword: 'GAS'"]),
    ),
    "weak word alone": ({"owner": "GAS PLAZA"}, NONE),
    "special alone": ({"zoning_subtype": "Special Commercial"}, NONE),
    "nothing known": ({}, NONE),
}


def test_classifier_cases(spark):
    rows = [(name, *(attrs.get(a) for a in PARCEL_ATTRS)) for name, (attrs, _) in CASES.items()]
    schema = "case_name string, " + ", ".join(f"{a} string" for a in PARCEL_ATTRS)
    grade = classify_parcel({a: F.col(a) for a in PARCEL_ATTRS})
    found = spark.createDataFrame(rows, schema).select("case_name", grade.alias("g")).collect()
    got = {r["case_name"]: (r["g"]["truck_flag"], r["g"]["confidence"], r["g"]["reasons"]) for r in found}
    assert got == {name: expected for name, (_, expected) in CASES.items()}


@pytest.fixture(scope="module")
def parcels(spark):
    def box(x: float, y: float) -> str:
        return f"POLYGON(({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y + 1}, {x} {y}))"

    even = ("Northgate Warehousing", "7 Canal Quay", "Industrial", "Industrial", "3900")
    odd = ("The Mill House", "4 Elm Row", "Residential", "Single Family", "1100")
    rows = [
        (i, box(10 * i, 0), *(even if i % 2 == 0 else odd), "polk", state)
        for i, state in enumerate(["IA", "CA", "IN", "RI", "AR"])
    ]
    rows.append((7, box(70, 0), *[None] * 7))
    # Two more parcels on top of parcel 1: the lowest id wins.
    rows += [(8, box(10, 0), *even, "x", "XX"), (9, box(9.5, -0.5), *even, "x", "XX")]
    frame = spark.createDataFrame(
        rows,
        "parcel_id int, wkt string, owner string, address string, zoning_type string, "
        "zoning_subtype string, lbcs_activity string, county string, state2 string",
    )
    return tracts_from_wkt(frame)


@pytest.fixture(scope="module")
def prospects(spark):
    return spark.createDataFrame(
        [(f"P00{i + 1}", 0.5, 10 * i + 0.5) for i in range(5)],
        "point_id string, lat double, lon double",
    )


def test_sample_prospects(prospects, parcels):
    out = enrich(prospects, parcels)
    assert out.columns == OUTPUT_COLUMNS
    rows = {r["point_id"]: r for r in out.collect()}
    first, second = rows["P001"], rows["P002"]
    assert first["truck_flag"] and first["confidence"] == "high"
    assert first["reasons"] == "keyword: 'Warehous';zoning: Industrial;lbcs_activity=3900"
    assert (second["truck_flag"], second["confidence"], second["reasons"]) == (
        False,
        "high",
        "no truck signal",
    )
    assert (second["parcel_owner"], second["state"]) == ("The Mill House", "CA")
    assert summary(out).first().asDict() == {
        "row_count": 5,
        "flagged": 3,
        "high_confidence": 5,
        "errors": 0,
    }


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_without_a_parcel(spark, parcels, broadcast):
    points = spark.createDataFrame(
        [
            ("out", "5", "5", None),
            ("out", "5", "5", None),
            ("empty", "0.5", "70.5", None),
            ("text", "x", "1", None),
            ("null", None, "1", None),
            ("nan", "NaN", "1", None),
            ("far", "91", "1", None),
            ("failed", "0.5", "0.5", "boom"),
        ],
        "point_id string, lat string, lon string, e string",
    )
    out = enrich(points, parcels, error_col="e", broadcast=broadcast).collect()
    rows = {r["point_id"]: r for r in out}
    assert len(out) == 8
    out_row = rows["out"]
    assert (out_row["truck_flag"], out_row["confidence"]) == (False, "high")
    assert (out_row["reasons"], out_row["parcel_owner"], out_row["error"]) == ("no parcel found", "", "")
    # A parcel of NULLs is a parcel: its attributes stay NULL.
    assert (rows["empty"]["reasons"], rows["empty"]["parcel_owner"]) == ("no truck signal", None)
    for name in ("text", "null", "nan", "far"):
        assert (rows[name]["confidence"], rows[name]["error"]) == ("error", "invalid coordinates")
    assert (rows["failed"]["reasons"], rows["failed"]["error"]) == ("boom", "boom")
    assert rows["failed"]["confidence"] == "error" and rows["failed"]["parcel_owner"] == ""


def test_limit_takes_first_by_id(prospects, parcels):
    ids = [r["point_id"] for r in enrich(prospects.orderBy(F.desc("point_id")), parcels, 2).collect()]
    assert sorted(ids) == ["P001", "P002"]


def test_missing_ids_are_row_positions(spark, tmp_path):
    spark.range(0, 1000, 1, 7).select(F.col("id").alias("lat")).write.parquet(str(tmp_path / "p"))
    frame = spark.read.parquet(str(tmp_path / "p"))
    ids = [r["point_id"] for r in ensure_point_id(frame).select("point_id").collect()]
    assert sorted(ids, key=lambda t: int(t[1:])) == [f"P{i}" for i in range(1000)]
    typed = ensure_point_id(spark.range(3).select(F.col("id").alias("point_id")))
    assert typed.schema["point_id"].dataType.simpleString() == "string"


def test_totals_come_with_the_action(prospects, parcels):
    seen = Observation()
    enrich(prospects, parcels, observation=seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 5, "flagged": 3}


def test_plan_has_no_python(prospects, parcels):
    plan = enrich(prospects, parcels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def shuffled(spark, frame, kind):
    wide = frame.withColumn("wide", F.repeat(F.lit("x"), 400))
    if kind == "group":
        return wide.groupBy("k").agg(F.max("wide").alias("wide"))
    if kind == "order":
        return wide.orderBy(F.desc("k"))
    if kind == "join":
        return wide.join(frame.withColumnRenamed("k", "j"), F.col("k") == F.col("j"))
    return wide.distinct()


@pytest.mark.parametrize("kind", ["group", "order", "join", "distinct"])
def test_ids_of_shuffled_rows_lose_no_row(spark, kind):
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = ensure_point_id(shuffled(spark, spark.range(3000).withColumnRenamed("id", "k"), kind)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(int(r["point_id"][1:]) for r in rows) == list(range(3000))
    assert len({r["k"] for r in rows}) == 3000


def test_empty_lookup_error_is_none_and_absent_columns_are_empty(spark, parcels):
    points = spark.createDataFrame(
        [("a", 0.5, 0.5, ""), ("b", 0.5, 5.0, "")], "point_id string, lat double, lon double, e string"
    )
    rows = enrich(points, parcels.drop("county"), error_col="e").collect()
    assert {(r["point_id"], r["confidence"], r["error"], r["county"]) for r in rows} == {
        ("a", "high", "", ""),
        ("b", "high", "", ""),
    }


def test_a_parcel_without_an_id_raises(spark, parcels, prospects):
    nameless = parcels.withColumn("parcel_id", F.when(F.col("parcel_id") != 8, F.col("parcel_id")))
    with pytest.raises(Exception, match="parcel_id must not be NULL"):
        enrich(prospects, nameless).collect()


def test_partition_starts_of_very_many_partitions(spark):
    """Counts of 300,000 partitions: summed in groups, and only the groups in one task."""
    from parcelgrid.operators.enrich import GROUP, partition_starts

    n = 300_000
    counts = spark.range(n).selectExpr("id AS p", "id * 7 % 13 AS __n").where("p % 1000 <> 5")
    starts = partition_starts(counts, "p", "s")
    total, rows = 0, starts.orderBy("p").collect()
    assert len(rows) == n - n // 1000
    for r in rows:
        assert r["s"] == total
        total += r["p"] * 7 % 13
    groups = starts.select((F.col("p") / GROUP).cast("int").alias("g")).distinct().count()
    assert groups < 300
