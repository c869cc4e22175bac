"""One rate for each service, however many tasks send to it, and the state of downloads, both as state of a stream.

A token bucket needs one number a service: the time at which the bucket would be full again.  It is kept in the stream's
state, so it outlives restarts, and requests get the time from which they may be sent.  Senders wait for that time and
need not know of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

NEVER = -(1 << 62)


def releases(times: np.ndarray, full_at: int, gap: int, burst: int) -> tuple[np.ndarray, int]:
    """When requests that arrive at ascending ``times`` may be sent, and when the bucket is full after them.

    The bucket holds ``burst`` tokens and gains one each ``gap``.
    """
    order = np.arange(len(times))
    full = (order + 1) * gap + np.maximum(np.maximum.accumulate(times - order * gap), full_at)  # after each request
    before = np.concatenate([[full_at], full[:-1]])
    return np.maximum(times, before - (burst - 1) * gap), int(full[-1])


def scheduled(requests: DataFrame, service: str, key: str, time: str, gap: float, burst: int = 1) -> DataFrame:
    """(service, key, arrived, release) of a stream of requests, times in microseconds since 1970.

    A service sends one request each ``gap`` seconds, and up to ``burst`` at once after a pause.  The requests of a
    service that arrive in one batch go by time and key, batches in their order; so a task holds a batch's requests of a
    service.  Requests without a service or a time are dropped.
    """
    micros = round(gap * 1e6)
    kind = requests.schema[key].dataType.simpleString()

    def schedule(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(["arrived", "key"])
        release, full = releases(rows["arrived"].to_numpy(np.int64), state.get[0] if state.exists else NEVER, micros, burst)
        state.update((full,))
        yield rows.assign(service=name[0], release=release)[["service", "key", "arrived", "release"]]

    given = requests.select(F.col(service).cast("string").alias("service"), F.col(key).alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("arrived")).dropna(subset=["service", "arrived"])
    made = given.groupBy("service").applyInPandasWithState(schedule, f"service string, key {kind}, arrived long, release long", "full long", "append", GroupStateTimeout.NoTimeout)
    return made.withColumnRenamed("key", key)


def download_states(outcomes: DataFrame, key: str, ok: str, most: int = 3) -> DataFrame:
    """(key, attempts, status) after each batch with outcomes of a key: ``done``, ``retry``, or ``failed`` after ``most`` attempts.

    What is done stays done, and outcomes after it are not counted.
    """
    kind = outcomes.schema[key].dataType.simpleString()

    def follow(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, done = state.get if state.exists else (0, False)
        for part in parts:
            for good in part["ok"]:
                if not done:
                    attempts, done = attempts + 1, bool(good)
        state.update((attempts, done))
        yield pd.DataFrame({"key": [name[0]], "attempts": [attempts], "status": ["done" if done else "failed" if attempts >= most else "retry"]})

    given = outcomes.select(F.col(key).alias("key"), F.coalesce(F.col(ok), F.lit(False)).alias("ok")).where("key is not null")
    made = given.groupBy("key").applyInPandasWithState(follow, f"key {kind}, attempts long, status string", "attempts long, done boolean", "update", GroupStateTimeout.NoTimeout)
    return made.withColumnRenamed("key", key)
