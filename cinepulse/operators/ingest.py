"""Decode, validate, normalise and encode activity messages.

Each function is DataFrame -> DataFrame and works on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse import schema as S
from cinepulse.functions.clock import as_of_column, iso_naive_text, iso_utc_text, parse_iso_timestamp

MALFORMED = "malformed"


def _decode_schema(keep_corrupt: bool) -> T.StructType:
    if not keep_corrupt:
        return S.EVENT_SCHEMA
    return T.StructType([*S.EVENT_SCHEMA.fields, T.StructField(S.CORRUPT_COLUMN, T.StringType(), True)])


def decode(
    messages: DataFrame,
    keep_corrupt: bool = False,
    value_col: str = "value",
    time_col: str = "timestamp",
    event_time_from: str = "message",
) -> DataFrame:
    """value BINARY, timestamp -> payload fields + event_time.

    ``event_time_from``: ``"message"`` (default) takes the message (broker) time;
    ``"payload"`` parses the payload's ISO ``timestamp`` text instead (NULL when it
    does not parse, so the row leaves the windowed aggregates).

    Permissive: a malformed payload gives a row whose fields are all NULL; the row
    is kept. With ``keep_corrupt`` the raw text of a payload that did not decode
    cleanly is kept in ``_corrupt_record`` and ``_decoded`` tells a NULL payload.
    """
    if event_time_from not in ("message", "payload"):
        raise ValueError(f"event_time_from must be 'message' or 'payload', not {event_time_from!r}")
    options = {"mode": "PERMISSIVE"}
    if keep_corrupt:
        options["columnNameOfCorruptRecord"] = S.CORRUPT_COLUMN
    data = F.from_json(F.col(value_col).cast("string"), _decode_schema(keep_corrupt), options)
    # The one-element explode is a Generate node: a later filter on decoded fields
    # cannot be pushed below it, so the optimizer does not copy ``from_json`` into
    # every predicate and field (one JSON parse per message, not one per use).
    # A NULL payload stays one row with a NULL struct.
    decoded = messages.select(F.explode(F.array(data)).alias("data"), F.col(time_col))
    event_time = F.col(time_col) if event_time_from == "message" else parse_iso_timestamp(F.col("data.timestamp")).cast("timestamp")
    cols = [F.col("data.*"), event_time.alias("event_time")]
    if keep_corrupt:
        cols.append(F.col("data").isNotNull().alias("_decoded"))
    return decoded.select(*cols)


def parse_events(messages: DataFrame, event_time_from: str = "message") -> DataFrame:
    """The reference decode: payload columns + event_time, malformed rows kept."""
    return decode(messages, keep_corrupt=False, event_time_from=event_time_from)


INTEGER_TEXT = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"


def _field(name: str, as_type: str) -> Column:
    return F.try_variant_get(F.col("json"), f"$[0].{name}", as_type)


def _kind(name: str) -> Column:
    """JSON type of a field, as a variant type name; NULL when absent."""
    return F.schema_of_variant(_field(name, "variant"))


def _integer(name: str) -> Column:
    """An optional integer as the model reads it: a whole number, a boolean, or text of
    a whole number; NULL for any other value and beyond 32 bits."""
    kind, number = _kind(name), _field(name, "double")
    text = F.regexp_replace(F.trim(_field(name, "string")), r"\.0*$", "")
    return (
        F.when(kind == "BOOLEAN", _field(name, "boolean").cast("int"))
        .when((kind == "STRING") & _field(name, "string").rlike(INTEGER_TEXT), text.try_cast("int"))
        .when((kind != "STRING") & (number == F.floor(number)), number.try_cast("int"))
    )


def classify(messages: DataFrame, value_col: str = "value", time_col: str = "timestamp") -> DataFrame:
    """Typed events with ``reject_reason`` (NULL when accepted) and, for every rejected
    row, the raw text in ``_corrupt_record``.

    The types are those of the declared model: a required field must be JSON text
    (``invalid_<field>`` for a number, boolean, object or array; ``missing_<field>``
    when absent or null), the rating may be absent, null, a whole number, a boolean or
    the text of a whole number (else ``invalid_rating_value``). Anything that is not
    one JSON object, also an object with text behind it or with a repeated key, is
    ``malformed``. One reason per row: malformed, then the first field at fault.
    """
    text = F.col(value_col).cast("string")
    # The parser stops at the end of the first value, so the message is read as the
    # first entry of an array that a hash of it closes: text behind the object breaks
    # the array or moves the hash from its place.
    mark = F.xxhash64(text)
    wrapped = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
    # One-element explode: one parse per message (see ``decode``).
    parsed = messages.select(
        text.alias(S.CORRUPT_COLUMN), mark.alias("mark"), F.col(time_col).alias("event_time"), F.explode(F.array(F.try_parse_json(wrapped))).alias("json")
    )
    whole = (F.try_variant_get("json", "$[1]", "long") == F.col("mark")) & F.schema_of_variant(F.try_variant_get("json", "$[0]", "variant")).startswith("OBJECT")
    strings = [f for f in S.PAYLOAD_FIELDS if f != "rating_value"]
    values = [F.when(_kind(f) == "STRING", _field(f, "string")).alias(f) for f in strings]
    kinds = [_kind(f).alias(f"_kind_{f}") for f in S.PAYLOAD_FIELDS]
    typed = parsed.select(*values, _integer("rating_value").alias("rating_value"), "event_time", S.CORRUPT_COLUMN, F.coalesce(whole, F.lit(False)).alias("_whole"), *kinds)

    reason = F.when(~F.col("_whole"), F.lit(MALFORMED))
    for f in S.REQUIRED_FIELDS:
        absent = F.coalesce(F.col(f"_kind_{f}"), F.lit("VOID")) == "VOID"
        reason = reason.when(absent, F.lit(f"missing_{f}")).when(F.col(f).isNull(), F.lit(f"invalid_{f}"))
    rated = F.coalesce(F.col("_kind_rating_value"), F.lit("VOID")) != "VOID"
    reason = reason.when(rated & F.col("rating_value").isNull(), F.lit("invalid_rating_value"))
    out = typed.withColumn("reject_reason", reason)
    raw = F.when(F.col("reject_reason").isNotNull(), F.col(S.CORRUPT_COLUMN))
    fields = [F.when(F.col("_whole"), F.col(f)).alias(f) for f in S.PAYLOAD_FIELDS]
    return out.select(*fields, "event_time", raw.alias(S.CORRUPT_COLUMN), "reject_reason")


def validate_events(messages: DataFrame, as_of=None) -> DataFrame:
    """Accepted events; the payload time is replaced by the intake instant ``as_of``
    (default: max message time, as a scalar subquery), typed TIMESTAMP_NTZ here.
    ``intake`` writes the same instant as ISO-8601 text, as the service publishes it."""
    classified = classify(messages)
    if as_of is None:
        stamp = messages.select(F.max("timestamp").cast("timestamp_ntz")).scalar()
    else:
        stamp = as_of_column(None, as_of)
    return classified.filter(F.col("reject_reason").isNull()).select(
        "user_id",
        "action",
        "movie_id",
        "genre",
        stamp.cast("timestamp_ntz").alias("timestamp"),
        "rating_value",
        "event_time",
    )


def intake(messages: DataFrame, as_of=None) -> DataFrame:
    """Every message once, with ``status`` = accepted / rejected and its reason.

    The JSON is parsed once; writing this frame partitioned by ``status`` lands the
    accepted table and the quarantine in one pass (``sources.lake.write_intake``).
    Accepted rows carry the intake instant in ``timestamp`` as ISO-8601 text
    (``as_of``; default the session clock, as the service stamps events on arrival).
    """
    stamp = as_of_column(None, as_of) if as_of is not None else F.localtimestamp()
    classified = classify(messages)
    accepted = F.col("reject_reason").isNull()
    return classified.select(
        *[c for c in S.PAYLOAD_FIELDS if c != "timestamp"],
        F.when(accepted, iso_naive_text(stamp)).otherwise(F.col("timestamp")).alias("timestamp"),
        "event_time",
        F.col(S.CORRUPT_COLUMN).alias("raw_payload"),
        F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
        "reject_reason",
    )


def quarantine(messages: DataFrame) -> DataFrame:
    """Rejected messages with their reason (the quarantine table)."""
    return classify(messages).filter(F.col("reject_reason").isNotNull())


def quarantine_counts(messages: DataFrame) -> DataFrame:
    return quarantine(messages).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("reject_reason", "reason")


def normalize_timestamps(df: DataFrame, text_col: str = "timestamp", out_col: str = "event_time") -> DataFrame:
    """Parse ISO-8601 text (``Z`` or zone-less) and drop rows that do not parse."""
    return df.withColumn(out_col, parse_iso_timestamp(text_col)).filter(F.col(out_col).isNotNull())


def encode_events(events: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Event rows -> value BINARY: the JSON payload, NULL fields written out."""
    fields = fields or S.PAYLOAD_FIELDS
    payload = F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})
    return events.select(payload.cast("binary").alias("value"))


#: Payload rewrites of ``to_messages(odd_every=...)``: pattern and replacement by the
#: remainder of the event id.
ODD_PAYLOADS = {
    1: (r'"user_id":"user_([0-9]+)"', r'"user_id":$1'),
    2: (r'"genre":(null|"[^"]*")', r'"genre":{}'),
    3: (r'"rating_value":([0-9]+)', r'"rating_value":"$1"'),
    4: (r'"rating_value":([0-9]+)', r'"rating_value":$1.0'),
    5: (r'"rating_value":(null|[0-9]+)', r'"rating_value":true'),
    6: (r"$", " x"),
    7: (r'"rating_value":(null|[0-9]+)', r'"rating_value":2.5'),
}


def to_messages(events: DataFrame, malformed_every: int | None = None, id_col: str = "event_id", odd_every: int | None = None) -> DataFrame:
    """Activity rows -> topic messages (value BINARY, timestamp TIMESTAMP).

    The payload time is the event time as ``...Z`` text and the message time is the
    event time. With ``malformed_every`` = n, the payload of every n-th event id is
    replaced by the broken text ``{bad`` (exercises the permissive decode). With
    ``odd_every`` = m, the payloads whose id leaves a remainder of 1 to 7 modulo m get
    other JSON types or text behind the object (exercises the intake's type rules).
    """
    payload = F.to_json(
        F.struct(
            "user_id",
            "action",
            "movie_id",
            "genre",
            iso_utc_text("event_time").alias("timestamp"),
            "rating_value",
        ),
        {"ignoreNullFields": "false"},
    )
    if odd_every:
        plain = payload
        for remainder, (pattern, other) in ODD_PAYLOADS.items():
            payload = F.when(F.col(id_col) % odd_every == remainder, F.regexp_replace(plain, pattern, other)).otherwise(payload)
    if malformed_every:
        payload = F.when(F.col(id_col) % malformed_every == 0, F.lit("{bad")).otherwise(payload)
    return events.select(
        payload.cast("binary").alias("value"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )
