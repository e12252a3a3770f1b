from pyspark.sql import functions as F

from meterflow.operators.routing import route_messages


def route(spark, values, topic="p1-electricity", absent="null"):
    rows = [(None, v, topic, 0, i, None, 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    )
    return {r.kafka_offset: r for r in route_messages(df, absent=absent).collect()}


def b(s):
    return s.encode() if isinstance(s, str) else s


def test_malformed_payloads(spark):
    vals = ['{broken', '[1,2]', 'null', '42', '{}', '', '{"a":1} trailing', '{"a":1}{"b":2}', '{"a":1},{"b":2}',
            '{"a":1,"a":2}', b'{"a":"\xff"}', '{"a": {"b": [1, {"c": 2}]}}', ' {"a":1} ', '{"a":"}"}']
    r = route(spark, [b(v) for v in vals])
    reasons = [r[i].reject_reason for i in range(len(vals))]
    assert reasons == ["malformed_json", "not_an_object", "not_an_object", "not_an_object", None, "malformed_json",
                       "malformed_json", "malformed_json", "malformed_json", None, "invalid_utf8", None, None, None]


def test_times_and_absent_policy(spark):
    vals = [
        '{"telegramTimestamp":"240101000000W","processingTimestampUTC":"2024-01-01T10:00:00Z"}',
        '{"processingTimestampUTC":"2024-01-01T12:00:00+02:00"}',
        '{"processingTimestampUTC":"2024-01-01T10:00:00.123456789Z"}',
        '{"processingTimestampUTC":"2024-01-01T10:00:00.1Z"}',
        '{"processingTimestampUTC":"2024-01-01T10:00:00"}',
        '{"processingTimestampUTC":"2025"}',
        '{"processingTimestampUTC":"nope","telegramTimestamp":5}',
        '{"processingTimestampUTC":"2024-02-30T10:00:00Z"}',
    ]
    r = route(spark, [b(v) for v in vals])
    ts = [None if r[i].processing_timestamp is None else r[i].processing_timestamp.strftime("%Y-%m-%d %H:%M:%S.%f")
          for i in range(len(vals))]
    assert ts[:4] == ["2024-01-01 10:00:00.000000"] * 2 + ["2024-01-01 10:00:00.123456", "2024-01-01 10:00:00.100000"]
    assert ts[4:] == [None, None, None, None]
    assert r[0].telegram_timestamp == "240101000000W" and r[6].telegram_timestamp is None
    rows = [(None, b(vals[6]), "p1-gas", 0, 0, None, 0)]
    df = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    )
    z = route_messages(df, absent="zero").select(
        "telegram_timestamp", F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss").alias("p")
    ).first()
    assert z.telegram_timestamp == "" and z.p == "0001-01-01 00:00:00"


def test_unknown_topic_and_fail_policy(spark):
    r = route(spark, [b("{}")], topic="p1-water")
    assert r[0].reject_reason == "unknown_topic" and r[0].route is None
    df = spark.createDataFrame([(None, b"[1]", "p1-gas", 0, 7, None, 0)],
                               "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    import pytest

    with pytest.raises(Exception):
        route_messages(df, on_malformed="fail").collect()


def test_long_strings_deep_nesting_and_repeated_keys_in_a_default_session(spark):
    plain = spark.newSession()  # none of the package's settings
    assert plain.conf.get("spark.sql.variant.allowDuplicateKeys") in ("false", "true")
    plain.conf.unset("spark.sql.variant.allowDuplicateKeys")
    big = "x" * 1_000_000
    vals = [
        '{"a":"%s"}' % big,
        '{"a":"%s"} tail' % big,
        '{"a":"%s"}' % ('\\"\\\\' * 200_000),
        '"%s"' % big,
        '{"a":1,"telegramTimestamp":"first","telegramTimestamp":"last"}',
        '{"a":%s1%s}' % ("[" * 400, "]" * 400),
    ]
    r = route(plain, [b(v) for v in vals])
    assert [r[i].reject_reason for i in range(len(vals))] == [None, "malformed_json", None, "not_an_object", None, None]
    assert r[4].telegram_timestamp == "last"


def test_fail_policy_raises_whatever_is_selected(spark):
    import pytest

    df = spark.createDataFrame(
        [(None, b"[1]", "p1-gas", 0, 7, None, 0), (None, b"[1]", "p1-water", 0, 8, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    with pytest.raises(Exception, match="malformed payload at p1-gas/0@7"):
        route_messages(df, on_malformed="fail").select("kafka_offset").collect()
    assert route_messages(df.where("topic = 'p1-water'"), on_malformed="fail").select("kafka_offset").count() == 1
