"""Contract rules, one case each, and the dead-letter envelope."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators import contract, enrich

BASE = {
    "event_id": "1b9d6bcd-bbfd-4b2d-9b5d-ab8dfbbd4bed", "customer_id": "customer-001",
    "heart_rate": 75, "event_time": "2026-08-30T10:00:00+00:00",
}


def changed(**fields):
    return json.dumps({**BASE, **fields})


def without(name):
    return json.dumps({k: v for k, v in BASE.items() if k != name})


CASES = {
    "base": (json.dumps(BASE), None),
    "lower bound": (changed(heart_rate=20), None),
    "upper bound": (changed(heart_rate=250), None),
    "whole decimal": (changed(heart_rate=75.0), None),
    "exponent": ('{"event_id":"1b9d6bcd-bbfd-4b2d-9b5d-ab8dfbbd4bed","customer_id":"c",'
                 '"heart_rate":7.5e1,"event_time":"2026-08-30T10:00:00Z"}', None),
    "zulu": (changed(event_time="2026-08-30T10:00:00Z"), None),
    "urn": (changed(event_id="urn:uuid:1b9d6bcd-bbfd-4b2d-9b5d-ab8dfbbd4bed"), None),
    "braces": (changed(event_id="{1B9D6BCDBBFD4B2D9B5DAB8DFBBD4BED}"), None),
    "missing customer": (without("customer_id"), "event: 'customer_id' is a required property"),
    "missing two": ('{"heart_rate":75,"customer_id":"c"}',
                    "event: 'event_id' is a required property; "
                    "event: 'event_time' is a required property"),
    "negative": (changed(heart_rate=-5), "heart_rate: -5 is less than the minimum of 20"),
    "low": (changed(heart_rate=5), "heart_rate: 5 is less than the minimum of 20"),
    "high": (changed(heart_rate=500), "heart_rate: 500 is greater than the maximum of 250"),
    "fraction": (changed(heart_rate=75.5), "heart_rate: 75.5 is not of type 'integer'"),
    "low fraction": (changed(heart_rate=5.5),
                     "heart_rate: 5.5 is not of type 'integer'; "
                     "heart_rate: 5.5 is less than the minimum of 20"),
    "high whole decimal": (changed(heart_rate=500.0),
                           "heart_rate: 500.0 is greater than the maximum of 250"),
    "string number": (changed(heart_rate="75"), "heart_rate: '75' is not of type 'integer'"),
    "boolean": (changed(heart_rate=True), "heart_rate: True is not of type 'integer'"),
    "null rate": (changed(heart_rate=None), "heart_rate: None is not of type 'integer'"),
    "bad id": (changed(event_id="not-a-uuid"), "Invalid event_id"),
    "bad id and time": (changed(event_id="x", event_time="y"), "Invalid event_id"),
    "bad time": (changed(event_time="not-a-date"), "Invalid event_time"),
    "naive time": (changed(event_time="2026-08-30T10:00:00"), "Invalid event_time"),
    "impossible date": (changed(event_time="2026-02-30T10:00:00Z"), "Invalid event_time"),
    "extra": (changed(injected=1),
              "event: Additional properties are not allowed ('injected' was unexpected)"),
    "extras": (changed(zeta=1, alpha=2),
               "event: Additional properties are not allowed ('alpha', 'zeta' were unexpected)"),
    "empty customer": (changed(customer_id=""), "customer_id: '' should be non-empty"),
    "null customer": (changed(customer_id=None), "customer_id: None is not of type 'string'"),
    "number customer": (changed(customer_id=5), "customer_id: 5 is not of type 'string'"),
    "quote": (changed(heart_rate="o'clock"), "heart_rate: \"o'clock\" is not of type 'integer'"),
    "order": (changed(customer_id="", heart_rate=5, extra=1),
              "event: Additional properties are not allowed ('extra' was unexpected); "
              "customer_id: '' should be non-empty; "
              "heart_rate: 5 is less than the minimum of 20"),
    "array": ("[1]", "event: [1] is not of type 'object'"),
    "null": ("null", "event: None is not of type 'object'"),
    "text": ('"hello"', "event: 'hello' is not of type 'object'"),
}


def messages(spark, values):
    return spark.createDataFrame(
        [(v.encode() if isinstance(v, str) else v, "topic", 2, i, dt.datetime(2026, 8, 30, 11))
         for i, v in enumerate(values)],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )


@pytest.fixture(scope="module")
def outcomes(spark):
    df = contract.validate(contract.decode(messages(spark, [v for v, _ in CASES.values()])))
    return dict(zip(CASES, df.orderBy("offset").collect(), strict=True))


@pytest.mark.parametrize("name", list(CASES))
def test_contract_case(outcomes, name):
    row, (_, expected) = outcomes[name], CASES[name]
    assert row["error_message"] == expected
    assert row["is_valid"] == (expected is None)
    assert row["error_type"] == (None if expected is None else "VALIDATION_ERROR")


def test_valid_rows_are_typed_and_canonical(outcomes):
    for name in ("urn", "braces", "base"):
        assert outcomes[name]["event_id"] == BASE["event_id"]
    assert outcomes["whole decimal"]["heart_rate"] == 75
    assert outcomes["exponent"]["heart_rate"] == 75
    assert outcomes["low"]["heart_rate"] is None


def test_undecodable_messages(spark):
    values = ["{", "not json", '{"a":1,"a":2}', b"\xff\xfe", "", '{"a":1} x',
              '{"a":1}],[{}', '{"a":1},"b":{}', '{"a":1},{}', '{"a":1}},{"v":{}', ","]
    rows = contract.validate(contract.decode(messages(spark, values))).collect()
    assert {r["error_type"] for r in rows} == {"DECODE_ERROR"}
    assert not any(r["is_valid"] for r in rows)


def test_dead_letter_envelope_and_key(spark):
    values = [changed(heart_rate=500), without("customer_id"), changed(customer_id=5), "{"]
    _, invalid = contract.split(contract.validate(contract.decode(messages(spark, values))))
    at = dt.datetime(2026, 8, 30, 12)
    letters = enrich.dead_letters(invalid, F.lit(at)).orderBy("source_offset")
    rows = letters.collect()
    assert [r["dlq_key"] for r in rows] == ["customer-001", "unknown", "unknown", "unknown"]
    assert rows[0]["original_event"] == values[0]
    assert (rows[0]["source_topic"], rows[0]["source_partition"], rows[0]["source_offset"]) == (
        "topic", 2, 0)
    published = [json.loads(r["value"]) for r in enrich.dead_letter_messages(letters).collect()]
    assert published[0]["original_event"]["heart_rate"] == 500
    assert published[0]["error_message"] == "heart_rate: 500 is greater than the maximum of 250"
    assert published[0]["failed_at"] == "2026-08-30T12:00:00.000000+00:00"
    assert published[3]["original_event"] == {"original_event": "{"}


def test_blank_lines_are_skipped(spark):
    kept = contract.skip_blank(messages(spark, [" ", "\t\n", json.dumps(BASE), " "]))
    assert kept.count() == 1


def test_length_limit_is_optional(spark):
    long = changed(customer_id="x" * 101)
    plain = contract.validate(contract.decode(messages(spark, [long]))).first()
    limited = contract.READING.with_max_length("customer_id", 100)
    strict = contract.validate(contract.decode(messages(spark, [long])), limited).first()
    assert plain["is_valid"] and not strict["is_valid"]
    assert strict["error_message"].endswith("is too long")


@pytest.mark.parametrize("raw,expected", [
    ("2026-08-30T10:00:00Z", (10, 0, 0, 0)),
    ("2026-08-30T10:00:00.5+00:00", (10, 0, 0, 500000)),
    ("2026-08-30 10:00:00,25+02:00", (8, 0, 0, 250000)),
    ("2026-08-30T10:00:00+0230", (7, 30, 0, 0)),
    ("2026-08-30T10:00:00-01", (11, 0, 0, 0)),
    ("2026-08-30T10:00+00:00", (10, 0, 0, 0)),
    ("2026-08-30T10+00:00", (10, 0, 0, 0)),
    ("20260830T100000Z", (10, 0, 0, 0)),
    ("2026-08-30T10:00:00.123456789Z", (10, 0, 0, 123456)),
    ("2026-08-30T23:00:00+23:00", (0, 0, 0, 0)),
    ("2026-08-30T10:00:00+00:00:30", (9, 59, 30, 0)),
    ("2026-08-30", None), ("2026-08-30T10:00:00", None), ("10:00:00Z", None),
    ("2026-08-30T10:00:00 Europe/Paris", None), ("2026-13-30T10:00:00Z", None),
    ("2026-08-30T25:00:00Z", None), ("", None), ("2026-08-30T10:00:00+24:00", None),
])
def test_event_time_forms(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "t string").select(
        times.parse_iso_with_offset(F.col("t"))).first()[0]
    if expected is None:
        assert got is None
    else:
        assert (got.hour, got.minute, got.second, got.microsecond) == expected


def test_uuid_forms(spark):
    plain = BASE["event_id"]
    good = [plain, plain.upper(), plain.replace("-", ""), "{" + plain + "}", "urn:uuid:" + plain]
    bad = ["", "not-a-uuid", plain[:-1], plain + "0", plain.replace("1", "g")]
    rows = spark.createDataFrame([(v,) for v in good + bad], "u string")
    got = [r[0] for r in rows.select(text.canonical_uuid(F.col("u"))).collect()]
    assert got == [plain] * len(good) + [None] * len(bad)


NESTED = {
    "type": "object", "required": ["kind"], "additionalProperties": False,
    "properties": {
        "kind": {"type": "string", "enum": ["a", "b", 3, True]},
        "inner": {"type": "object", "required": ["n"], "additionalProperties": False,
                  "properties": {"n": {"type": "number", "maximum": 5}, "deep": {
                      "type": "object", "properties": {"flag": {"type": "boolean"}}}}},
    },
}


@pytest.mark.parametrize(("body", "message"), [
    ('{"kind":"a"}', None),
    ('{"kind":"b","inner":{"n":4.5,"deep":{"flag":true,"more":1}}}', None),
    ('{"kind":3}', "kind: 3 is not of type 'string'"),
    ('{"kind":"c"}', "kind: 'c' is not one of ['a', 'b', 3, True]"),
    ('{"inner":{"n":1}}', "event: 'kind' is a required property"),
    ('{"kind":"a","inner":{}}', "inner: 'n' is a required property"),
    ('{"kind":"a","inner":{"n":6,"x":1,"y":2}}',
     "inner: Additional properties are not allowed ('x', 'y' were unexpected); inner.n: 6 is greater than the maximum of 5"),
    ('{"kind":"a","inner":{"n":1,"deep":{"flag":0}}}', "inner.deep.flag: 0 is not of type 'boolean'"),
    ('{"kind":"a","inner":{"n":1,"deep":7}}', "inner.deep: 7 is not of type 'object'"),
    ('{"kind":"a","inner":null}', "inner: None is not of type 'object'"),
])
def test_a_schema_document_states_the_contract(spark, body, message):
    rows = spark.createDataFrame([(body.encode(),)], "value binary")
    got = contract.validate(contract.decode(rows), contract.from_schema(NESTED)).first()
    assert (got.error_message, got.is_valid) == (message, message is None)
    if message is None and "4.5" in body:
        assert (got.kind, got.inner_n, got.inner_deep_flag) == ("b", 4.5, True)


def test_documents_that_would_go_unchecked_are_refused():
    for document in (
        {"type": "object", "properties": {"a": {"type": "string", "pattern": "x"}}},
        {"type": "object", "required": ["b"], "properties": {"a": {"type": "string"}}},
        {"type": "string"},
    ):
        with pytest.raises(ValueError):
            contract.from_schema(document)
