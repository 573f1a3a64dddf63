from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.samples import bronze, instant, payload
from tidemart.operators.quality import data_quality_report
from tidemart.operators.validate import (
    coerce_events,
    parse_payload,
    route_quarantine,
    route_valid,
    validate_contract_rules,
    validate_stream_rules,
)
from tidemart.schema import REQUIRED_FIELDS


def errors_of(spark, rules, *payloads) -> list[list[str]]:
    rows = rules(bronze(spark, *payloads)).orderBy("offset").collect()
    return [row.validation_errors for row in rows]


def test_stream_rules_route_one_valid_and_one_invalid(spark):
    validated = validate_stream_rules(
        bronze(spark, payload(), payload(event_id="evt-2", event_type="signup"))
    )
    assert route_valid(validated).count() == 1
    assert [r.validation_errors for r in route_quarantine(validated).collect()] == [
        ["invalid_event_type"]
    ]


def test_stream_rules_codes_and_order(spark):
    all_missing = ["malformed_json", *(f"{name}_missing" for name in REQUIRED_FIELDS)]
    nameless = payload()
    del nameless["event_id"]
    found = errors_of(
        spark,
        validate_stream_rules,
        "{broken",
        nameless,
        payload(user_id=None, event_type="x"),
        payload(event_type="purchase", order_id="o", order_amount=0),
        payload(event_type="purchase", order_id="", order_amount=1.5),
        payload(event_type=None),
        None,
        "",
    )
    assert found == [
        all_missing,
        ["malformed_json", "event_id_missing"],
        ["user_id_missing", "invalid_event_type"],
        ["purchase_missing_order_fields"],
        [],
        ["event_type_missing"],
        all_missing,
        all_missing,
    ]


def test_contract_accepts_valid_payload(spark):
    assert errors_of(spark, validate_contract_rules, payload()) == [[]]


def test_contract_required_and_blank(spark):
    found = errors_of(
        spark,
        validate_contract_rules,
        payload(user_id=None),
        payload(user_id=""),
        payload(user_id=" \t　"),
        payload(event_type="  "),
        payload(event_type=""),
        payload(event_type="login"),
    )
    required = ["user_id is required"]
    allowed = (
        "event_type must be one of "
        "['add_to_cart', 'checkout_start', 'home_view', 'product_view', 'purchase']"
    )
    assert found == [
        required,
        required,
        required,
        ["event_type is required", allowed],
        ["event_type is required"],
        [allowed],
    ]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-01-01T10:00:00Z", "2025-01-01T10:00:00"),
        ("2025-01-01T10:00:00", "2025-01-01T10:00:00"),
        ("2025-01-01 10:00", "2025-01-01T10:00:00"),
        ("2025-01-01T10", "2025-01-01T10:00:00"),
        ("2025-01-01T10+02:00", "2025-01-01T08:00:00"),
        ("2025-01-01T10:00+02:00", "2025-01-01T08:00:00"),
        ("2025-01-01T10:00:30+02", "2025-01-01T08:00:30"),
        ("2025-01-01", "2025-01-01T00:00:00"),
        ("2025-01-01T10:00:00.123456+05:30", "2025-01-01T04:30:00.123456"),
    ],
)
def test_contract_reads_iso_times(spark, text, expected):
    row = validate_contract_rules(bronze(spark, payload(event_time=text))).select(
        "validation_errors", F.col("event_time").cast("timestamp_ntz").alias("at")
    ).first()
    assert row.validation_errors == []
    assert row.at == instant(expected).replace(tzinfo=None)


def test_contract_rejects_other_times(spark):
    found = errors_of(
        spark,
        validate_contract_rules,
        payload(event_time="not-a-time"),
        payload(event_time="10:00:00"),
        payload(event_time="2025"),
        payload(event_time="2025-13-01T00:00:00Z"),
        payload(event_time=1735725600),
        payload(event_time="1735725600"),
        payload(ingest_time=""),
    )
    invalid = "event_time is invalid: Invalid isoformat string: "
    assert found == [
        [f"{invalid}'not-a-time'"],
        [f"{invalid}'10:00:00'"],
        [f"{invalid}'2025'"],
        [f"{invalid}'2025-13-01T00:00:00+00:00'"],
        ["event_time is invalid: unsupported timestamp value: 1735725600"],
        [f"{invalid}'1735725600'"],
        ["ingest_time is required", "ingest_time is invalid: Invalid isoformat string: ''"],
    ]


def test_contract_schema_version_by_json_type(spark):
    low, bad = ["schema_version must be >= 1"], ["schema_version must be an integer"]
    cases = [
        (2, []), ("2", []), (" 3 ", []), (1.0, []), (1.9, []), (True, []),
        (0, low), (-1, low), (0.5, low), (False, low), ("0", low),
        ("1.0", bad), ("abc", bad), ("true", bad), ([1], bad), (2**40, bad),
    ]
    found = errors_of(
        spark, validate_contract_rules, *(payload(schema_version=value) for value, _ in cases)
    )
    assert found == [expected for _, expected in cases]


def test_contract_purchase_fields(spark):
    no_order = "order_id is required for purchase events"
    not_positive = "order_amount must be > 0 for purchase events"
    not_number = "order_amount must be numeric for purchase events"
    cases = [
        (None, None, [no_order, not_positive]),
        ("", 5, [no_order]),
        (0, 5, [no_order]),
        (False, 5, [no_order]),
        ("0", 5, []),
        ("o", 0, [not_positive]),
        ("o", -1.5, [not_positive]),
        ("o", "19.0", []),
        ("o", " 19.0 ", []),
        ("o", True, []),
        ("o", False, [not_positive]),
        ("o", "true", [not_number]),
        ("o", "abc", [not_number]),
        ("o", "1.0d", [not_number]),
        ("o", "NaN", [not_number]),
        ("o", "1e999", [not_number]),
    ]
    payloads = [
        payload(event_type="purchase", order_id=order, order_amount=amount)
        for order, amount, _ in cases
    ]
    found = errors_of(spark, validate_contract_rules, *payloads)
    assert found == [expected for _, _, expected in cases]


def test_contract_malformed_payloads(spark):
    texts = ["{broken", "[1]", "null", "5", '"text"', "", "   ", None, "{'event_id': 'x'}"]
    found = errors_of(spark, validate_contract_rules, *texts)
    assert found == [["malformed_json"]] * len(texts)
    assert errors_of(spark, validate_contract_rules, "{}")[0] == [
        f"{name} is required" for name in REQUIRED_FIELDS
    ]


def test_repeated_member_takes_the_last(spark):
    text = '{"event_id":"a","event_id":"b"}'
    assert parse_payload(bronze(spark, text)).first().event_id == "b"
    assert validate_contract_rules(bronze(spark, text)).first().event_id == "b"


def test_routes_partition_the_rows(spark):
    rows = bronze(spark, payload(), payload(user_id=" "), "{broken", None, payload(event_type="x"))
    for rules in (validate_stream_rules, validate_contract_rules):
        validated = rules(rows)
        assert route_valid(validated).count() + route_quarantine(validated).count() == 5


def test_parse_runs_once_under_a_filter(spark):
    for rules, route in (
        (validate_stream_rules, route_valid),
        (validate_contract_rules, route_quarantine),
    ):
        plan = route(rules(bronze(spark, payload())))._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("from_json(StructField(event_id") == 1


def test_coerce_types_and_nulls(spark):
    purchase = payload(
        event_id="evt-2", event_type="purchase", order_id="o-1", order_amount="19.0",
        schema_version="2",
    )
    rows = coerce_events(bronze(spark, payload(order_id=""), purchase, payload(user_id=None)))
    first, second = rows.orderBy("event_id").collect()
    assert (first.order_id, first.order_amount, first.schema_version) == (None, None, 1)
    assert (second.order_id, second.order_amount, second.schema_version) == ("o-1", 19.0, 2)


def test_coerce_fail_fast_names_the_errors(spark):
    good = bronze(spark, payload())
    assert coerce_events(good, fail_fast=True).count() == 1
    with pytest.raises(PySparkException, match="user_id is required; event_type must be one of"):
        coerce_events(
            bronze(spark, payload(user_id=None, event_type="x")), fail_fast=True
        ).collect()


def test_event_date_falls_back_to_topic_date(spark):
    validated = validate_contract_rules(
        bronze(spark, payload(event_time="2024-12-31T23:59:59Z"), payload(event_time="bad"))
    )
    dates = [str(row.event_date) for row in validated.orderBy("offset").collect()]
    assert dates == ["2024-12-31", "2025-01-01"]


def test_quality_report(spark):
    again = payload(user_id="user-2", session_id="session-2", event_type="signup")
    report = data_quality_report(bronze(spark, payload(), again)).first()
    assert report.asDict() == {
        "total_events": 2,
        "valid_events": 1,
        "invalid_events": 1,
        "duplicate_event_ids": 1,
        "invalid_event_types": 1,
        "missing_required_fields": 0,
    }


def test_quality_report_counts_errors_and_text_ids_only(spark):
    report = data_quality_report(
        bronze(
            spark,
            payload(event_id=5),
            payload(event_id=5),
            payload(event_id="5"),
            payload(event_type=None, user_id=None),
            "{broken",
        )
    ).first()
    assert report.duplicate_event_ids == 0
    assert (report.total_events, report.invalid_events) == (5, 2)
    assert (report.invalid_event_types, report.missing_required_fields) == (1, 2)


@pytest.mark.parametrize(
    "tail,good",
    [("", True), (" \n", True), (" x", False), ("{}", False), (',{"a":1}', False), ("] }", False), ("} {", False)],
)
def test_the_whole_payload_is_judged(spark, tail, good):
    text = json.dumps(payload()) + tail
    row = validate_contract_rules(bronze(spark, text)).first()
    assert (row.validation_errors == []) == good


def test_braces_inside_values_are_no_end(spark):
    row = validate_contract_rules(bronze(spark, payload(country_code="a}b"), payload(extra={"k": {}}))).collect()
    assert [r.validation_errors for r in row] == [[], []]


def test_amounts_are_kept_or_reported(spark):
    cases = {"abc": "order_amount must be numeric", "\t5\n": None, 1e23: "order_amount is too large", 9e21: None}
    frame = bronze(spark, *(payload(event_type="product_view", order_amount=a) for a in cases))
    found = [r.validation_errors for r in validate_contract_rules(frame).orderBy("offset").collect()]
    assert found == [[text] if text else [] for text in cases.values()]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("20250101T100000", "2025-01-01T10:00:00"),
        ("20250101T1000Z", "2025-01-01T10:00:00"),
        ("2025-01-01T10:00:00,5+0530", "2025-01-01T04:30:00.500000"),
        ("2025-W01-3T10", "2025-01-01T10:00:00"),
        ("2020W537", "2021-01-03T00:00:00"),
        ("20250101", "2025-01-01T00:00:00"),
        ("2025-W54-1", None),
        ("2025-W53-1", None),
        ("2025-01-01T10:00:00+00:00\n", None),
        ("2025-0101", None),
    ],
)
def test_iso_forms(spark, text, expected):
    row = validate_contract_rules(bronze(spark, payload(event_time=text))).first()
    assert (row.event_time and row.event_time.isoformat()) == expected
    assert bool(row.validation_errors) == (expected is None)


@pytest.mark.parametrize("columns", [["event_id"], ["user_id", "event_type"], None])
def test_fail_fast_cannot_be_pruned(spark, columns):
    frame = coerce_events(bronze(spark, payload(), payload(user_id=None)), fail_fast=True)
    with pytest.raises(Exception, match="user_id is required"):
        frame.count() if columns is None else frame.select(*columns).collect()
