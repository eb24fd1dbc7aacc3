"""Two seeded fleets and a lab table of 100,000 rows given by formulas, with their known answers."""

from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.model import Property, ViewDef
from viewloom.operators.aggregates import (
    Metric,
    aggregate,
    as_view_rows,
    grouped_counts,
    long_form,
    parse_metrics,
)
from viewloom.operators.filters import FilterSpec
from viewloom.operators.scan import conform, scan

COUNT = Metric("count", "externalId")
BOAT = ViewDef("sailboat", "SmallBoat", "v1", (Property("name"), Property("description")))
CERTIFICATE = ViewDef(
    "sailboat",
    "ORCCertificate",
    "v1",
    (Property("name"), Property("aph_tod", "float64"), Property("issued", "timestamp")),
)
A, B = "inst_sailboat_fleet_a", "inst_sailboat_fleet_b"


@pytest.fixture(scope="module")
def boats(spark):
    data = [("one", "d", A, "a1"), ("two", "d", A, "a2"), ("three", None, A, "a3"), ("four", "d", B, "b1"),
            ("five", "d", B, "b2")]
    return conform(spark.createDataFrame(data, "name string, description string, space string, external_id string"),
                   BOAT)


@pytest.fixture(scope="module")
def certificates(spark):
    data = [("c1", 480.5, A, "c1"), ("c2", 512.0, A, "c2"), ("c3", 530.25, A, "c3"), ("c4", 600.0, B, "c4")]
    table = spark.createDataFrame(data, "name string, aph_tod double, space string, external_id string")
    return conform(table.withColumn("issued", F.current_timestamp()), CERTIFICATE)


def test_fleets(boats, certificates):
    count = lambda **spec: scan(boats, BOAT, FilterSpec(**spec)).count()
    assert count(instance_space=A) == 3
    assert count(instance_space=[A, B]) == 5
    assert count(instance_space="sailboat") == 0
    assert count(instance_space=A, exists="description") == 2
    assert rows(aggregate(boats, BOAT, [COUNT], spec=FilterSpec(instance_space=B))) == [(2,)]
    low_high = [Metric("min", "aph_tod"), Metric("max", "aph_tod")]
    spec = FilterSpec(instance_space=A)
    got = aggregate(certificates, CERTIFICATE, low_high, spec=spec)
    assert got.columns == ["min_aph_tod", "max_aph_tod"] and rows(got) == [(480.5, 530.25)]
    assert rows(long_form(got, low_high)) == [("max", "aph_tod", 530.25), ("min", "aph_tod", 480.5)]


def test_aggregate_of_nothing(boats, certificates):
    spec = FilterSpec(instance_space="nowhere")
    metrics = [COUNT, Metric("max", "aph_tod")]
    empty = aggregate(certificates, CERTIFICATE, metrics, spec=spec)
    assert rows(empty) == [(0, None)]
    assert rows(long_form(empty, metrics)) == [("count", "externalId", 0.0), ("max", "aph_tod", None)]
    assert rows(grouped_counts(boats, BOAT, ["space"], spec)) == []


def test_view_layout_last_metric_wins(certificates):
    metrics = [COUNT, Metric("min", "aph_tod"), Metric("max", "aph_tod")]
    keys = ["space", "name"]
    spec = FilterSpec(equals={"name": ["c1", "c4"]})
    got = as_view_rows(aggregate(certificates, CERTIFICATE, metrics, keys, spec), CERTIFICATE, metrics, keys)
    assert got.columns == CERTIFICATE.columns
    assert rows(got.select("name", "aph_tod", "space", "external_id", "issued")) == [
        ("c1", 480.5, A, "1", None), ("c4", 600.0, B, "1", None)]


@pytest.mark.parametrize(
    ("metrics", "message"),
    [
        ([Metric("count", "externalId")] * 6, "at most 5"),
        ([{"fn": "", "property": "x"}] * 6, "at most 5"),
        ([], "needs a list"),
        ("{}", "needs a list"),
        ([{"fn": "min"}, 5], "none of the metrics"),
        ([Metric("min", "name")], "numeric"),
        ([Metric("max", "issued")], "numeric"),
        ([Metric("count", "nope")], "no property"),
        ([Metric("median", "aph_tod")], "unknown aggregate"),
    ],
)
def test_aggregate_checks(certificates, metrics, message):
    with pytest.raises(ValueError, match=message):
        aggregate(certificates, CERTIFICATE, metrics)


def test_malformed_metrics_are_skipped():
    assert parse_metrics('[{"fn": " COUNT ", "property": "external_id"}, {"fn": "min"}, 3]') == [
        Metric("count", "external_id")]


LAB = ViewDef(
    "lims",
    "LimsResult",
    "v1",
    (
        Property("resultId", "int64", nullable=False),
        Property("aliquotId"),
        Property("componentName", nullable=False),
        Property("resultType"),
        Property("numericValue", "float64"),
        Property("isOutOfSpec", "boolean"),
        Property("enteredTimestamp", "timestamp"),
        Property("auditComment"),
    ),
)
LAB_A, LAB_B = "inst_lims_result_lab_a", "inst_lims_result_lab_b"


@pytest.fixture(scope="module")
def lab(spark):
    """The columns of the lab table that have known answers, by the formulas of its description."""
    i = F.col("id")
    kind = (
        F.when(i % 100 < 70, "NUMERIC").when(i % 100 < 85, "TEXT").when(i % 100 < 93, "LIST")
        .when(i % 100 < 98, "CALCULATED").otherwise("FILE")
    )
    out = (i % 100 == 0) & (i != 1)
    number = (
        F.when(i == 1, 12.5).when(~kind.isin("NUMERIC", "CALCULATED"), None).when(out, 1500.0)
        .otherwise((i % 1000).cast("double"))
    )
    component = F.when(i % 10 == 1, "MOISTURE_CONTENT").otherwise(F.concat(F.lit("COMPONENT_"), i % 10))
    day = F.lit("2024-01-01").cast("date")
    return conform(
        spark.range(1, 100001).select(
            i.alias("resultId"),
            F.when(i % 5 != 0, F.concat(F.lit("ALQ-"), F.lpad(i.cast("string"), 6, "0"))).alias("aliquotId"),
            component.alias("componentName"),
            kind.alias("resultType"),
            number.alias("numericValue"),
            out.alias("isOutOfSpec"),
            F.date_add(day, (i % 366).cast("int")).cast("timestamp").alias("enteredTimestamp"),
            F.when(i == 1, "Fixture row for equality checks.").when(i % 1000 == 0, F.repeat(F.lit("A"), 3500))
            .when(i % 7 != 0, F.concat(F.lit("Entered for result "), i, F.lit("."))).alias("auditComment"),
            F.when(i <= 60000, LAB_A).otherwise(LAB_B).alias("space"),
            F.concat(F.lit("result_"), F.lpad(i.cast("string"), 6, "0")).alias("external_id"),
        ),
        LAB,
    ).cache()


def test_lab_counts(lab):
    count = lambda **spec: rows(aggregate(lab, LAB, [COUNT], spec=FilterSpec(**spec)))[0][0]
    assert count(instance_space=LAB_A) == 60000
    assert count(instance_space=LAB_B) == 40000
    assert count(instance_space=[LAB_A, LAB_B]) == 100000
    assert count(instance_space="lims") == 0
    assert count(equals={"componentName": "MOISTURE_CONTENT"}) == 10000
    assert count(equals={"isOutOfSpec": True}) == 1000
    assert count(not_exists="aliquotId") == 20000
    assert count(exists="aliquotId") == 80000
    month = dict(gte={"enteredTimestamp": "2024-01-01T00:00:00Z"},
                 lt={"enteredTimestamp": datetime(2024, 2, 1, tzinfo=timezone.utc)})
    assert count(**month) == 8493


def test_lab_min_max_and_groups(lab):
    metrics = [Metric("min", "numericValue"), Metric("max", "numericValue")]
    for space in (LAB_A, LAB_B):
        assert rows(aggregate(lab, LAB, metrics, spec=FilterSpec(instance_space=space))) == [(1.0, 1500.0)]
    in_a = FilterSpec(instance_space=LAB_A)
    groups = rows(grouped_counts(lab, LAB, ["componentName"], in_a))
    assert len(groups) == 10 and {n for _, n in groups} == {6000}
    one = FilterSpec(instance_space=LAB_A, equals={"componentName": "MOISTURE_CONTENT"})
    assert rows(grouped_counts(lab, LAB, ["componentName"], one)) == [("MOISTURE_CONTENT", 6000)]
    both = rows(grouped_counts(lab, LAB, ["space", "componentName"]))
    assert len(both) == 20 and {(s, n) for s, _, n in both} == {(LAB_A, 6000), (LAB_B, 4000)}
    assert rows(grouped_counts(lab, LAB, ["space"])) == [(LAB_A, 60000), (LAB_B, 40000)]
    capped = aggregate(lab, LAB, [COUNT], ["externalId"], max_groups=1000)
    assert [r.external_id for r in capped.limit(2).collect()] == ["result_000001", "result_000002"]
    assert capped.count() == 1000


def test_lab_rows(lab):
    some = scan(lab, LAB, FilterSpec(instance_space=LAB_A), limit=2).collect()
    assert len(some) == 2 and {r.space for r in some} == {LAB_A}
    long = scan(lab, LAB, FilterSpec(external_id="result_001000"), [F.length("auditComment")])
    assert rows(long) == [(3500,)]
    first = scan(lab, LAB, FilterSpec(external_id="result_000001")).first()
    assert (first.componentName, first.numericValue, first.resultType, first.isOutOfSpec) == (
        "MOISTURE_CONTENT", 12.5, "NUMERIC", False)
