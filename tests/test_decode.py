import pytest
from conftest import utc

from adtally.operators import decode, requests
from adtally.schemas import BID_TOPIC, IMPRESSION_TOPIC, RECORD

ARRIVED = utc(2024, 5, 1, 12)


def records(spark, values, topic=BID_TOPIC):
    rows = [(topic, 0, n, n, None, v, ARRIVED) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD)


def reasons(spark, values, topic=BID_TOPIC):
    rows = decode.decode(records(spark, values, topic)).orderBy("seq").collect()
    return [r.reason for r in rows]


STRICT = [
    ('{"bid_id":"a","campaign_id":"c","timestamp":5}', None),
    (' \n{"bid_id":"a","campaign_id":"c"}\t', None),
    ('{"bid_id":7,"campaign_id":"c"}', "invalid_json"),
    ('{"bid_id":true,"campaign_id":"c"}', "invalid_json"),
    ('{"bid_id":{"x":1},"campaign_id":"c"}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":"5"}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":1.5}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":1e3}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":9223372036854775808}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":1700000000000}', "bad_timestamp"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":1700000000000000}', "bad_timestamp"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":-9223372036854775808}', "bad_timestamp"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":9223372036854775807}', "bad_timestamp"),
    ('{"bid_id":"a","campaign_id":"c","timestamp":253402300799}', None),
    ('{"bid_id":"a","campaign_id":"c","request_id":1}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c"} x', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c"}{"bid_id":"b","campaign_id":"c"}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c"},{"bid_id":"b","campaign_id":"c"}', "invalid_json"),
    ('{"bid_id":"a","campaign_id":"c","bid_id":"b"}', None),
    ('{"bid_id":"a","campaign_id":"c","other":[1,{"bid_id":2}]}', None),
    ('{"bid_id":null,"campaign_id":"c"}', "missing_required"),
    ('{"BID_ID":"a","campaign_id":"c"}', "missing_required"),
    ('{"bid_id":"a"}', "missing_required"),
    ('{"bid_id":"a","campaign_id":""}', "missing_required"),
    ("[]", "invalid_json"),
    ("5", "invalid_json"),
    ('"text"', "invalid_json"),
    ("null", "missing_required"),
    ("", "invalid_json"),
    (None, "invalid_json"),
    ('{"bid_id":"broken"', "invalid_json"),
]


def test_strict_bids(spark):
    assert reasons(spark, [v for v, _ in STRICT]) == [r for _, r in STRICT]


def test_impressions_need_only_the_bid_id(spark):
    values = ['{"bid_id":"a"}', '{"bid_id":"a","campaign_id":5}', '{"bid_id":"a","request_id":5}', "{}"]
    assert reasons(spark, values, IMPRESSION_TOPIC) == [None, "invalid_json", None, "missing_required"]


def test_last_duplicate_key_wins(spark):
    df = decode.decode(records(spark, ['{"bid_id":"a","campaign_id":"c","bid_id":"b"}']))
    assert df.first().bid_id == "b"


def test_zero_timestamp_is_the_arrival_time(spark):
    values = ['{"bid_id":"a","campaign_id":"c","timestamp":0}', '{"bid_id":"b","campaign_id":"c"}']
    values.append('{"bid_id":"d","campaign_id":"c","timestamp":60}')
    rows = decode.decode(records(spark, values)).selectExpr("unix_seconds(event_ts) AS s").collect()
    assert [r.s for r in rows] == [int(ARRIVED.timestamp())] * 2 + [60]


def test_unexpected_topic_fails(spark):
    with pytest.raises(Exception, match="unexpected topic"):
        decode.decode(records(spark, ["{}"], "other")).collect()


def test_every_record_is_accepted_or_quarantined(spark):
    """All columns are computed, so a conversion that throws would show."""
    decoded = decode.decode(records(spark, [v for v, _ in STRICT]))
    taken = decode.changes(decoded).collect()
    assert len(taken) + len(decode.quarantine(decoded).collect()) == len(STRICT)
    assert all(r.event_ts is not None for r in taken)


def test_change_log_types(spark):
    schema = "seq BIGINT, event_type STRING, entity_id STRING, event_ts TIMESTAMP, payload STRING"
    good = [(1, "bid_seen", "a", ARRIVED, '{"bid_id":"a","campaign_id":"c"}'), (2, "impression_seen", "a", ARRIVED, "{}")]
    rows = decode.changes_from_log(spark.createDataFrame(good, schema)).orderBy("seq").collect()
    assert [(r.kind, r.bid_id, r.campaign_id) for r in rows] == [("bid", "a", "c"), ("impression", "a", None)]
    with pytest.raises(Exception, match="unsupported event type"):
        decode.changes_from_log(spark.createDataFrame([(1, "other", "a", ARRIVED, "{}")], schema)).collect()


def test_campaign_rules(spark):
    users = ["123", "456", "789", "999", ""]
    df = requests.select_campaign(spark.createDataFrame([(u,) for u in users], "user_idfv STRING"))
    assert [r.campaign_id for r in df.collect()] == ["campaign1", "campaign2", None, "campaign_default", "campaign_default"]
    assert [r.no_fill for r in requests.fill_counts(df.drop("campaign_id")).collect()] == [1]


def test_billing_outcomes(spark):
    rows = [
        (0, '{"bid_id":"a","timestamp":1}', utc(2024, 1, 1)),
        (1, '{"bid_id":"a"} trailing', utc(2024, 1, 1, 23)),
        (2, '{"bid_id":"a"}', utc(2024, 1, 2)),
        (3, '{"timestamp":1}', utc(2024, 1, 1)),
        (4, '{"bid_id":"broken"', utc(2024, 1, 1)),
        (5, "{bad-json", utc(2024, 1, 1)),
        (6, '{"bid_id":5}', utc(2024, 1, 1)),
        (7, "", utc(2024, 1, 1)),
    ]
    df = requests.classify_billing(spark.createDataFrame(rows, "seq BIGINT, value STRING, arrival_ts TIMESTAMP"))
    got = {r.seq: r.outcome for r in df.collect()}
    assert got == {
        0: "accepted",
        1: "duplicate",
        2: "accepted",
        3: "missing_id",
        4: "malformed",
        5: "malformed",
        6: "malformed",
        7: "malformed",
    }
    events = requests.impression_events(df).collect()
    assert sorted((e.bid_id, e.campaign_id, e.user_idfv) for e in events) == [("a", "", "")] * 2
