"""Row comparison and a slow, literal model of the anomaly confirmation."""

from __future__ import annotations

import datetime as dt
from collections import Counter


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return Counter(tuple(r) for r in picked.collect())


HITS = "device_id string, timestamp timestamp_ntz, message_id bigint, entry int, entries int, rule int, reading double"


def hits(spark, messages):
    """Narrow anomaly rows of (device, time, id, [rule, ...]) messages."""
    data = [
        (device, time, message, i + 1, len(rules), rule, 50.0)
        for device, time, message, rules in messages
        for i, rule in enumerate(rules)
    ]
    return spark.createDataFrame(data, HITS)


def expected_confirmations(messages):
    """Message by message as they arrive: {(message id, rule): confirmed}."""
    history, result = {}, {}
    for device, time, message, broken in messages:
        visible = list(history.get(device, [])[-20:])
        for rule in broken:
            visible.append((time, rule))
            similar = [1 for t, r in visible if r == rule and time - t <= dt.timedelta(hours=1)]
            result[(message, rule)] = len(similar) >= 3
        history[device] = visible[-20:]
    return result


def confirmations(df):
    return {(r.message_id, r.rule): r.is_confirmed for r in df.collect()}
