"""Decode, validation, timestamp normalisation and JSON encode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse.operators import ingest
from cinepulse.sources.fixtures import sample_events

from helpers import rows

MSG = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())])
NOW = dt.datetime(2024, 1, 15, 10, 30)

# Fixed value: the documented sample message.
SAMPLE_MESSAGE = (
    '{"user_id":"user_123","action":"play","movie_id":"A","genre":"Sci-Fi",'
    '"timestamp":"2024-01-15T10:30:00Z","rating_value":4}'
)


def messages(spark, texts):
    return spark.createDataFrame([(None if s is None else bytearray(s.encode()), NOW) for s in texts], MSG)


def test_decode_sample(spark):
    got = rows(ingest.parse_events(messages(spark, [SAMPLE_MESSAGE])))
    assert got == [("user_123", "play", "A", "Sci-Fi", "2024-01-15T10:30:00Z", 4, NOW)]


def test_malformed_rows_kept_all_null(spark):
    parsed = ingest.parse_events(messages(spark, ["{bad", "[1,2]", "", None]))
    got = rows(parsed)
    assert len(got) == 4
    assert all(r[:6] == (None,) * 6 and r[6] == NOW for r in got)


def test_wrong_types(spark):
    texts = [
        '{"user_id":"u","action":"rate","movie_id":"A","genre":"X","timestamp":"t","rating_value":4.5}',
        '{"user_id":"u","action":"rate","movie_id":"A","genre":"X","timestamp":"t","rating_value":"5"}',
        '{"user_id":12,"action":"rate","movie_id":"A","genre":"X","timestamp":"t","rating_value":3,"extra":1}',
    ]
    got = rows(ingest.parse_events(messages(spark, texts)), "user_id", "movie_id", "rating_value")
    assert got == [("u", "A", None), ("u", "A", None), ("12", "A", 3)]


def test_validate_and_quarantine(spark):
    texts = [
        SAMPLE_MESSAGE,
        "{bad",
        None,
        '{"user_id":"u","action":"play","movie_id":"A","timestamp":"t"}',  # no genre
        '{"action":"play","movie_id":"A","timestamp":"t"}',  # no user, no genre
        '{"user_id":"u","action":"rate","movie_id":"A","genre":"X","timestamp":"t","rating_value":4.5}',
    ]
    msgs = messages(spark, texts)
    accepted = ingest.validate_events(msgs, as_of=NOW)
    assert rows(accepted, "user_id", "timestamp") == [("user_123", NOW)]
    counts = dict(rows(ingest.quarantine_counts(msgs)))
    assert counts == {"malformed": 2, "missing_genre": 1, "missing_user_id": 1, "invalid_rating_value": 1}


BODY = '"action":"rate","movie_id":"A","genre":"X","timestamp":"t"'


def test_declared_types(spark):
    """JSON types of the model: text fields take text only, the rating whole numbers in any dress."""
    ratings = {"5": 5, "5.0": 5, "true": 1, "false": 0, '"5"': 5, '" 7 "': 7, '"3.0"': 3, "-2": -2, "null": None, "1e2": 100}
    bad = ["4.5", '"x"', '""', "{}", "[1]", "99999999999", '"4.5"']
    texts = [f'{{"user_id":"u{i}",{BODY},"rating_value":{r}}}' for i, r in enumerate([*ratings, *bad])]
    accepted = dict(rows(ingest.validate_events(messages(spark, texts), as_of=NOW), "user_id", "rating_value"))
    assert accepted == {f"u{i}": v for i, v in enumerate(ratings.values())}
    assert rows(ingest.quarantine_counts(messages(spark, texts))) == [("invalid_rating_value", len(bad))]

    reasons = {
        f'{{"user_id":12,{BODY}}}': "invalid_user_id",
        f'{{"user_id":{{"a":1}},{BODY}}}': "invalid_user_id",
        f'{{"user_id":true,{BODY}}}': "invalid_user_id",
        f'{{"user_id":null,{BODY}}}': "missing_user_id",
        f'{{"user_id":"u",{BODY}}} x': "malformed",
        f'{{"user_id":"u",{BODY}}}{{}}': "malformed",
        f'{{"user_id":"u",{BODY}}},{{}}': "malformed",
        f'{{"user_id":"u",{BODY}}}] x': "malformed",
        "[]": "malformed",
        "12": "malformed",
        "": "malformed",
    }
    q = ingest.quarantine(messages(spark, [*reasons, None]))
    got = dict(rows(q, "_corrupt_record", "reject_reason"))
    assert got == {**reasons, None: "malformed"}  # the raw text of every reject is kept
    spaced = f' \n{{"user_id":"u","extra":[1,{{}}],{BODY}}}\t'
    assert ingest.validate_events(messages(spark, [spaced]), as_of=NOW).count() == 1


def test_normalize_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-15T10:30:00Z",), ("2024-01-15T10:30:00.250000",), ("",), ("junk",), (None,)], "timestamp string"
    )
    got = rows(ingest.normalize_timestamps(df), "event_time")
    assert got == [(NOW,), (NOW + dt.timedelta(milliseconds=250),)]


def test_encode_writes_nulls_and_round_trips(spark):
    ev = sample_events(spark).withColumn("timestamp", F.lit("x"))
    encoded = ingest.encode_events(ev)
    texts = [bytes(r.value).decode() for r in encoded.collect()]
    assert all('"rating_value":' in s for s in texts)
    assert '"rating_value":null' in texts[0]
    back = ingest.parse_events(encoded.withColumn("timestamp", F.lit(NOW)))
    assert rows(back, "movie_id", "rating_value")[:3] == [("A", None), ("A", None), ("A", 4)]


def test_to_messages_malformed_every(spark, sf_small):
    from cinepulse.sources.adapter import activity

    ev = activity(spark, sf_small)
    parsed = ingest.parse_events(ingest.to_messages(ev, malformed_every=97))
    n_bad = ev.filter("event_id % 97 = 0").count()
    assert parsed.filter("user_id is null").count() == n_bad
    assert parsed.count() == ev.count()


def test_intake_one_pass_both_tables(spark):
    from cinepulse.session import fresh_path
    from cinepulse.sources import lake

    msgs = messages(spark, [SAMPLE_MESSAGE, "{bad", '{"user_id":"u","action":"play","movie_id":"A","timestamp":"t"}'])
    out = ingest.intake(msgs, as_of=NOW)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert p.count("parse_json(") + p.count("parseJson") == 1, p
    path = lake.write_intake(out, fresh_path(spark, "intake"), replace_partitions=True)
    lake.write_intake(out, path, replace_partitions=True)  # a rerun replaces, not duplicates
    back = spark.read.parquet(path)
    assert back.count() == 3
    got = sorted(rows(back, "status", "reject_reason", "timestamp"), key=str)
    assert got == sorted(
        [("accepted", None, "2024-01-15T10:30:00.000000"), ("rejected", "malformed", None), ("rejected", "missing_genre", "t")], key=str
    )
    assert rows(back.filter("status = 'rejected' and reject_reason = 'malformed'"), "raw_payload") == [("{bad",)]


def test_intake_stream(spark):
    from cinepulse.session import fresh_path
    from cinepulse.sources import files
    from cinepulse.streaming import queries as streams

    src = files.write_messages(messages(spark, [SAMPLE_MESSAGE, "{bad"]), fresh_path(spark, "msgs"))
    out, ckpt = fresh_path(spark, "intake"), fresh_path(spark, "ckpt")
    streams.await_all([streams.start_intake(files.read_message_stream(spark, src), out, ckpt, trigger="availableNow")], 300)
    assert sorted(rows(spark.read.parquet(out), "status")) == [("accepted",), ("rejected",)]


def test_event_time_from_payload(spark):
    msgs = messages(spark, [SAMPLE_MESSAGE.replace("10:30:00Z", "09:00:00Z"), "{bad"])
    by_message = rows(ingest.parse_events(msgs), "event_time")
    by_payload = rows(ingest.parse_events(msgs, event_time_from="payload"), "event_time")
    assert by_message == [(NOW,), (NOW,)]
    assert by_payload == [(dt.datetime(2024, 1, 15, 9, 0),), (None,)]
