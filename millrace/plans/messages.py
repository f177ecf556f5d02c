"""Route broker messages to telemetry, events and rejects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import EVENTS_RAW, EVENTS_TOPIC, TELEMETRY, TELEMETRY_TOPIC

_WHOLE = (T.IntegerType, T.LongType)
# Fields that hold a time as text; it is stored as it came, but has to be readable.
_TIMES = {"timestamp", "event_timestamp"}


class Routed(NamedTuple):
    telemetry: DataFrame
    events: DataFrame
    rejects: DataFrame


def parse_records(messages: DataFrame) -> DataFrame:
    """One row per record of the JSON payloads, as a variant in ``record``; null where there is none to read.

    A payload is an object or an array of objects; an empty array counts as an object without fields.
    Each payload is parsed once. One that names a field twice, or is larger than a variant can be, is unreadable.
    """
    read = messages.withColumn("_payload", F.explode_outer(F.array(F.try_parse_json("value"))))
    listed = F.try_variant_get("_payload", "$", "array<variant>")
    some = F.when(F.size(listed) == 0, F.array(F.parse_json(F.lit("{}")))).otherwise(listed)
    records = F.when(listed.isNotNull(), some).otherwise(F.array("_payload"))
    return read.withColumn("record", F.explode_outer(records)).drop("_payload")


def _typed(field: T.StructField) -> tuple[Column, Column]:
    """The value of a field read as text, and whether text is there that does not fit.

    Whole numbers may be written with a fraction of zero, and numbers in quotes.
    """
    text = F.col("_read.texts")[field.name]
    if isinstance(field.dataType, T.StringType):
        bad = text.isNotNull() & text.try_cast("timestamp_ntz").isNull() if field.name in _TIMES else F.lit(False)
        return text, bad
    if isinstance(field.dataType, _WHOLE):
        kind, number = field.dataType.simpleString(), text.try_cast("double")
        value = F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number).try_cast(kind))
    else:
        value = text.try_cast(field.dataType.simpleString())
    return value, text.isNotNull() & value.isNull()


def read_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds the fields of ``schema``, ``extra`` (all other fields, nested and typed), and ``reason`` where a record is bad.

    Reasons: bad_json (no object), missing_device_id (also an empty one), and
    bad_value with the names of the fields whose text does not fit.
    """
    texts = ", ".join(f"{f.name}: string" for f in schema.fields)
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    every = F.try_variant_get("record", "$", "map<string,variant>")
    # As a generated column, so that no field is looked up again for the conditions on it.
    read = records.withColumn(
        "_read",
        F.explode(
            F.array(
                F.struct(
                    F.try_variant_get("record", "$", f"struct<{texts}>").alias("texts"),
                    F.map_filter(every, lambda k, _: ~F.array_contains(names, k)).alias("extra"),
                )
            )
        ),
    )
    typed = {f.name: _typed(f) for f in schema.fields}
    bad = F.array_compact(F.array(*[F.when(unfit, name) for name, (_, unfit) in typed.items()]))
    reason = (
        F.when(F.col("_read.texts").isNull(), "bad_json")
        .when(F.coalesce(F.trim("_read.texts.device_id"), F.lit("")) == "", "missing_device_id")
        .when(F.size(bad) > 0, F.concat(F.lit("bad_value: "), F.array_join(bad, ", ")))
    )
    return read.select(
        *records.columns,
        *[value.alias(name) for name, (value, _) in typed.items()],
        F.col("_read.extra").alias("extra"),
        reason.alias("reason"),
    )


def route_messages(envelopes: DataFrame, ingest_date: Column | None = None) -> Routed:
    """Split (topic, key, value) messages by topic into rows ready to be stored.

    Every record of a payload becomes a row under its own device, with the date
    of processing in ``date`` and fields beyond the declared ones in the map
    ``extra`` of variants. What cannot be stored goes to ``rejects`` with a ``reason``: those
    of ``read_records``, one row per record, or unknown_topic. So the records
    stored and rejected are all there are. Stateless, for batches and streams.
    """
    day = F.current_date() if ingest_date is None else ingest_date

    def of(topic: str, schema: T.StructType) -> DataFrame:
        return read_records(parse_records(envelopes.filter(F.col("topic") == topic)), schema)

    def stored(read: DataFrame, schema: T.StructType) -> DataFrame:
        return read.filter(F.col("reason").isNull()).select(*schema.fieldNames(), "extra").withColumn("date", day)

    known = {TELEMETRY_TOPIC: TELEMETRY, EVENTS_TOPIC: EVENTS_RAW}
    read = {topic: of(topic, schema) for topic, schema in known.items()}
    others = parse_records(envelopes.filter(~F.coalesce(F.col("topic").isin(*known), F.lit(False))))
    others = read_records(others, T.StructType([TELEMETRY["device_id"]]))
    others = others.withColumn("reason", F.coalesce("reason", F.lit("unknown_topic")))
    listed = F.startswith(F.ltrim("value"), F.lit("[")) & F.col("record").isNotNull()
    columns = ["topic", "key", F.when(listed, F.to_json("record")).otherwise(F.col("value")).alias("value"), "reason"]
    rejects = others.select(*columns)
    for rows in read.values():
        rejects = rejects.unionByName(rows.filter(F.col("reason").isNotNull()).select(*columns))
    telemetry, events = (stored(read[topic], schema) for topic, schema in known.items())
    return Routed(telemetry, events, rejects.withColumn("date", day))
