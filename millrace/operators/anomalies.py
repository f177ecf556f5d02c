"""Anomaly rules on telemetry and their confirmation in batch.

``anomaly_rules`` gives narrow rows (who, when, which rule, the reading); the
wording is added by ``describe`` at the end, so that shuffles and the streaming
state operator carry only what they need.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import number_text
from millrace.functions.times import epoch_seconds

# Thresholds, names and wording of the four rules. U+202F is a
# narrow no-break space, U+2011 a non-breaking hyphen.
ENERGY_LIMIT, ENERGY_CRITICAL = 4.5, 6.0
TEMPERATURE_LIMIT, TEMPERATURE_CRITICAL = 28.0, 32.0
VIBRATION_LIMIT = 3.0
SIGNAL_LIMIT = 30
TYPE_NAMES = ["high_energy_usage", "high_temperature", "high_vibration", "low_signal"]
TEXT_BEFORE = ["Energy usage ", "Temperature ", "Vibration ", "Signal strength "]
TEXT_AFTER = [
    "\u202fkWh (threshold:\u202f4.5)",
    "\u202f°C (threshold:\u202f28)",
    "\u202fm/s² (threshold:\u202f3.0)",
    "% (threshold:\u202f30)",
]
CONFIRMED_SUFFIX = " (Auto\u2011Confirmed)"
CONFIRMED_BY = "system"

# An anomaly is confirmed by this many of its type, itself included, within an
# hour, looking at the last HISTORY entries of the device before the message.
SIMILAR_NEEDED = 3
HISTORY = 20
WITHIN_SECONDS = 3600

NO_SLICE = -(2**40)

NARROW = ["device_id", "timestamp", "message_id", "entry", "entries", "rule", "reading"]


def anomaly_rules(telemetry: DataFrame, message_id: str) -> DataFrame:
    """One narrow row per rule a reading breaks; missing readings break none.

    ``entry`` numbers the anomalies of one message in rule order and
    ``entries`` is how many it has. A time that cannot be read is null.
    Stateless, so it works on streams too.
    """
    limits = {
        "energy_usage": F.col("energy_usage") > ENERGY_LIMIT,
        "temperature": F.col("temperature") > TEMPERATURE_LIMIT,
        "vibration": F.col("vibration") > VIBRATION_LIMIT,
        "signal_strength": F.col("signal_strength") < SIGNAL_LIMIT,
    }
    broken = {name: F.coalesce(rule, F.lit(False)) for name, rule in limits.items()}
    # Four candidates per message, filtered after the explode: plain column
    # arithmetic that stays inside generated code, unlike array functions with
    # a lambda.
    candidates, so_far = [], F.lit(0)
    for rule, name in enumerate(broken, start=1):
        so_far = so_far + F.col(f"_broken_{name}").cast("int")
        candidates.append(
            F.struct(
                F.col(f"_broken_{name}").alias("broken"),
                so_far.alias("entry"),
                F.lit(rule).alias("rule"),
                F.col(name).cast("double").alias("reading"),
            )
        )
    return (
        telemetry.select(
            "device_id",
            "timestamp",
            F.col(message_id).alias("message_id"),
            *broken,
            *[hit.alias(f"_broken_{name}") for name, hit in broken.items()],
        )
        .filter(reduce(lambda a, b: a | b, [F.col(f"_broken_{name}") for name in broken]))
        .select(
            "device_id",
            F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
            "message_id",
            so_far.alias("entries"),
            F.inline(F.array(*candidates)),
        )
        .filter("broken")
        .select(*NARROW)
    )


def confirm_batch(rules: DataFrame, slice_hours: int = 6, keep_slice: bool = False) -> DataFrame:
    """Add ``is_confirmed`` to the rows of ``anomaly_rules``, taken in time order.

    In time order "three of the type within an hour among the visible entries"
    means: the entry two back of the same type is no older than an hour and no
    further back than the history reaches. Both need only the hour before a
    row, so the work is cut into slices of ``slice_hours`` per device, each
    given a copy of the hour before it. A device with a large share of the rows
    is thereby spread over many tasks, and the rows are shuffled once. With
    ``keep_slice`` the column ``time_slice`` stays, by which together with the
    device the rows are partitioned; later windows over these need no shuffle.
    Anomalies without a time stay unconfirmed, in a slice of their own.
    """
    width = slice_hours * 3600
    seconds = epoch_seconds(F.col("timestamp"))
    own = F.coalesce(F.floor(seconds / width), F.lit(NO_SLICE))
    last = F.coalesce(F.floor((seconds + WITHIN_SECONDS + 1) / width), F.lit(NO_SLICE))
    sliced = rules.withColumn("_own", own).withColumn("time_slice", F.explode(F.sequence(own, last)))
    by_device = Window.partitionBy("device_id", "time_slice").orderBy("timestamp", "message_id", "entry")
    by_type = Window.partitionBy("device_id", "time_slice", "rule").orderBy("_seq")
    back = SIMILAR_NEEDED - 1
    before_message = F.col("_seq") - F.col("entry")
    confirmed = (F.col("_back_seq") > before_message - HISTORY) & (
        F.col("timestamp") <= F.col("_back_time") + F.expr(f"interval {WITHIN_SECONDS} seconds")
    )
    return (
        sliced.withColumn("_seq", F.row_number().over(by_device))
        .withColumn("_back_seq", F.lag("_seq", back).over(by_type))
        .withColumn("_back_time", F.lag("timestamp", back).over(by_type))
        .filter(F.col("_own") == F.col("time_slice"))
        .select(
            *rules.columns,
            F.coalesce(confirmed, F.lit(False)).alias("is_confirmed"),
            *(["time_slice"] if keep_slice else []),
        )
    )


def confirm_arrivals(rules: DataFrame, parts: int = 16, hot_rows: int = 1_000_000) -> DataFrame:
    """Add ``is_confirmed`` to rows of ``anomaly_rules``, taken as they arrived: by message_id and entry.

    A row looks back at the entries of its own message and at the ``HISTORY`` ones
    before it, so it needs no more than the 23 rows before it. A device with
    more than ``hot_rows`` rows is cut into ``parts`` ranges of message_id with
    about as many rows each; every range also gets the last rows of the ranges
    before it. Other devices are one range. Anomalies without a time stay
    unconfirmed and are nobody's history.
    """
    reach = HISTORY + len(TYPE_NAMES) - 1
    cuts = (
        rules.groupBy(F.col("device_id").alias("_device"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("message_id", [i / parts for i in range(1, parts)], 10_000).alias("_cuts"),
        )
        .filter(F.col("_n") > hot_rows)
    )
    ranged = rules.join(cuts, F.col("device_id").eqNullSafe(F.col("_device")), "left").withColumn(
        "_range", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("message_id"))), F.lit(0))
    )
    timed = F.col("timestamp").isNotNull()
    back = Window.partitionBy("device_id", "_range", timed).orderBy(F.desc("message_id"), F.desc("entry"))
    tails = (
        ranged.filter(F.col("_device").isNotNull() & (F.col("_range") < parts - 1))
        .withColumn("_back", F.row_number().over(back))
        .filter(F.col("_back") <= reach)
        .withColumn("_range", F.explode(F.sequence(F.col("_range") + 1, F.lit(parts - 1))))
        .withColumn("_copy", F.lit(True))
    )
    rows = ranged.withColumn("_copy", F.lit(False)).unionByName(tails.drop("_back"))
    order = Window.partitionBy("device_id", "_range", timed).orderBy("message_id", "entry")
    similar = F.lit(1)
    for distance in range(1, reach + 1):
        alike = (
            (F.lag("rule", distance).over(order) == F.col("rule"))
            & (F.col("timestamp") <= F.lag("timestamp", distance).over(order) + F.expr(f"interval {WITHIN_SECONDS} seconds"))
            & (F.lit(distance) < F.col("entry") + HISTORY)
        )
        similar = similar + F.coalesce(alike, F.lit(False)).cast("int")
    return (
        rows.withColumn("_similar", similar)
        .filter(~F.col("_copy"))
        .select(*rules.columns, (F.col("_similar") >= SIMILAR_NEEDED).alias("is_confirmed"))
    )


def last_arrivals(rules: DataFrame) -> DataFrame:
    """What later arrivals have to know: the last ``HISTORY`` timed rows of each device.

    Their message_id is replaced by numbers that come before all others, so
    that they stay first whatever arrives next.
    """
    order = Window.partitionBy("device_id").orderBy(F.desc("message_id"), F.desc("entry"))
    ranked = rules.filter(F.col("timestamp").isNotNull()).withColumn("_back", F.row_number().over(order))
    first = F.lit(-(2**63)) + HISTORY - F.col("_back")
    return ranked.filter(F.col("_back") <= HISTORY).withColumn("message_id", first).select(*NARROW)


def _pick(values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule"))


def describe(rules: DataFrame) -> DataFrame:
    """The anomaly columns in full; rows without ``is_confirmed`` count as unconfirmed."""
    confirmed = F.col("is_confirmed") if "is_confirmed" in rules.columns else F.lit(False)
    critical = ((F.col("rule") == 1) & (F.col("reading") > ENERGY_CRITICAL)) | (
        (F.col("rule") == 2) & (F.col("reading") > TEMPERATURE_CRITICAL)
    )
    severity = (
        F.when(critical, F.lit("CRITICAL")).when(F.col("rule") == 4, F.lit("MEDIUM")).otherwise(F.lit("HIGH"))
    )
    reading = F.when(F.col("rule") == 4, F.col("reading").cast("bigint").cast("string")).otherwise(
        number_text(F.col("reading"))
    )
    suffix = F.when(confirmed, F.lit(CONFIRMED_SUFFIX)).otherwise(F.lit(""))
    return rules.select(
        "device_id",
        "timestamp",
        _pick(TYPE_NAMES).alias("anomaly_type"),
        severity.alias("severity"),
        F.concat(_pick(TEXT_BEFORE), reading, _pick(TEXT_AFTER), suffix).alias("description"),
        confirmed.alias("is_confirmed"),
        F.when(confirmed, F.lit(CONFIRMED_BY)).alias("confirmed_by"),
        "message_id",
        "entry",
        "entries",
    )
