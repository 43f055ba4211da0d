import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.operators.enrich import enrich
from millpulse.operators.parse import (
    classify_messages,
    parse_messages,
    quarantine_counts,
    quarantined,
    valid_events,
)
from millpulse.schemas import EVENT, READING

GOOD = json.dumps({
    "timestamp": "2024-01-01T00:00:00", "machine_id": "machine_1", "vibration_mms": 1.5,
    "temperature_c": 36.6, "pressure_bar": 2.0, "rms_vibration": 0.7, "mean_temp": 36.0,
    "fault_label": 1,
})
FOREIGN = '{"probe":true,"timestamp":"2024-01-01T00:00:00"}'


def messages(spark, *values):
    rows = [(i, bytearray(v.encode() if isinstance(v, str) else v) if v is not None else None)
            for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("value", T.BinaryType())])
    return spark.createDataFrame(rows, schema)


def parsed(spark, value):
    row = parse_messages(messages(spark, value)).first()
    return {k: v for k, v in row.asDict().items() if v is not None}


def test_good_message(spark):
    assert parsed(spark, GOOD) == json.loads(GOOD)


def test_unreadable_messages_stay_as_empty_rows(spark):
    for value in ("not json", "{}", "", None, '[{"machine_id":"a"}]', '{"fault_label":1.0}',
                  '{"fault_label":3000000000}'):
        assert parsed(spark, value) == {}, value


def test_single_fields_fail_alone(spark):
    assert parsed(spark, '{"temperature_c":"abc","machine_id":"m"}') == {"machine_id": "m"}
    assert parsed(spark, '{"timestamp":5,"machine_id":7}') == {"timestamp": "5", "machine_id": "7"}
    assert parsed(spark, '{"machine_id":"a","extra":1}') == {"machine_id": "a"}
    assert math.isnan(parsed(spark, '{"temperature_c":NaN,"machine_id":"m"}')["temperature_c"])


def test_broken_utf8_is_replaced(spark):
    value = b'{"machine_id":"' + b"\xff" + b'A"}'
    assert parsed(spark, value) == {"machine_id": "�A"}


def test_foreign_message_becomes_a_reading(spark):
    row = enrich(parse_messages(messages(spark, FOREIGN))).first()
    assert row["timestamp"] == "2024-01-01T00:00:00" and row["machine_id"] is None
    assert row["temp_status"] == "NORMAL" and row["is_fault"] is None


def test_enriched_columns_and_types(spark):
    readings = enrich(parse_messages(messages(spark, GOOD)))
    assert [(f.name, f.dataType) for f in readings.schema] == [(f.name, f.dataType) for f in READING]


def test_reasons(spark):
    values = {
        "": "empty", "  ": "empty", "not json": "malformed_json", '[{"machine_id":"a"}]': "malformed_json",
        "{}": "bad_event_time", FOREIGN: "missing_machine_id",
        '{"timestamp":"garbage","machine_id":"m"}': "bad_event_time",
        '{"timestamp":"2024-01-01T00:00:00","machine_id":"m","temperature_c":"abc"}': "bad_field",
        GOOD: "valid",
    }
    rows = classify_messages(messages(spark, *values, None), "id").collect()
    assert [r["reason"] for r in sorted(rows)] == [*values.values(), "empty"]


def test_split_keeps_every_message_once(spark):
    classified = classify_messages(messages(spark, GOOD, "not json", FOREIGN, None))
    assert valid_events(classified).columns == EVENT.names
    assert valid_events(classified).count() == 1
    assert {r["raw"] for r in quarantined(classified).collect()} == {"not json", FOREIGN, None}
    counts = {r["reason"]: r["messages"] for r in quarantine_counts(classified).collect()}
    assert counts == {"valid": 1, "malformed_json": 1, "missing_machine_id": 1, "empty": 1}


finite = st.floats(allow_nan=False, allow_infinity=False)
event = st.tuples(
    st.none() | st.text(st.characters(codec="utf-8", exclude_categories=("Cs",))),
    st.none() | st.text(st.characters(codec="utf-8", exclude_categories=("Cs",))),
    *[st.none() | finite] * 5,
    st.none() | st.integers(-(2**31), 2**31 - 1),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=30))
def test_encoded_events_parse_to_themselves(spark, events):
    rows = spark.createDataFrame(events, EVENT)
    value = F.to_json(F.struct(*EVENT.names)).cast("binary").alias("value")
    back = [tuple(r) for r in parse_messages(rows.select(value)).collect()]
    assert sorted(map(repr, back)) == sorted(map(repr, events))


def test_a_time_without_a_date_is_quarantined(spark):
    message = '{"timestamp":"12:30:00","machine_id":"m"}'
    rows = spark.createDataFrame([(bytearray(message.encode()),)], "value binary")
    assert classify_messages(rows).first()["reason"] == "bad_event_time"
