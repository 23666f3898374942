"""A state machine for each key of a stream: rules lead from state to state, states may time out, and what is held survives
restarts in the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Rules:
    """Transitions (state, event) to state; events without one change nothing. timeouts: how many seconds a state lasts at
    most, and the state after it. Keys begin in start."""

    start: str
    transitions: dict[tuple[str, str], str]
    timeouts: dict[str, tuple[int, str]] = field(default_factory=dict)

    def expired(self, state: str, since: int, now: int) -> Iterator[tuple[int, str, str]]:
        """The timeouts, as (time, from, to), that end before now or with it; times are milliseconds."""
        while state in self.timeouts and (at := since + 1000 * self.timeouts[state][0]) <= now:
            yield at, state, self.timeouts[state][1]
            since, state = at, self.timeouts[state][1]


class Machine(StatefulProcessor):
    """Applies rules to a key's events in order of time and id, and emits each transition."""

    def __init__(self, rules: Rules, key: str):
        self.rules, self.key = rules, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", T.StructType([T.StructField("state", T.StringType()), T.StructField("since", T.LongType())]))

    def _rows(self, key, steps: list[tuple]) -> Iterator[pd.DataFrame]:
        if steps:
            out = pd.DataFrame(steps, columns=["at_ms", "at_us", "event_id", "was", "now"])
            out.insert(0, self.key, key[0])
            out[["at_us", "event_id"]] = out[["at_us", "event_id"]].astype("Int64")
            yield out

    def _hold(self, state: str, since: int) -> None:
        self.held.update((state, since))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state in self.rules.timeouts:
            self.handle.registerTimer(since + 1000 * self.rules.timeouts[state][0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, since = self.held.get() if self.held.exists() else (self.rules.start, 0)
        steps, begun = [], (state, since)
        # The events of one key in one batch; a batch has as many files as the stream takes at a time.
        for at, exact, number, event in pd.concat(rows).sort_values(["at_us", "event_id"])[["at_ms", "at_us", "event_id", "event"]].itertuples(index=False):
            for end, was, after in list(self.rules.expired(state, since, int(at))):
                steps.append((end, None, None, was, after))
                state, since = after, end
            if (after := self.rules.transitions.get((state, event))) is not None:
                steps.append((int(at), int(exact), number, state, after))
                state, since = after, int(at)
        if (state, since) != begun:
            self._hold(state, since)
        yield from self._rows(key, steps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, since = self.held.get()
        steps = []
        for end, was, after in list(self.rules.expired(state, since, expiredTimerInfo.getExpiryTimeInMs())):
            steps.append((end, None, None, was, after))
            state, since = after, end
        if steps:
            self._hold(state, since)
        yield from self._rows(key, steps)

    def close(self) -> None:
        pass


def transitions(events: DataFrame, key: str, event: str, rules: Rules, late: str = "0 seconds") -> DataFrame:
    """(key, at_ms, at_us, event_id, was, now): the transitions of a stream of events (key, event, ts, event_id).

    at_ms is the event's time rounded to milliseconds, in which timeouts are counted; at_us, the time itself in microseconds,
    puts events in order. Timeouts come as rows without at_us and event_id, at the latest once the stream's watermark, `late` behind the newest event, has
    passed them. Events without key, time or name are left out. Rows of one batch are put in order; between batches they
    count in the order that they come in.
    """
    spark = events.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)
    timed = events.filter(F.col(key).isNotNull() & F.col("ts").isNotNull() & F.col(event).isNotNull()).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    rows = timed.select(key, "ts", F.round(F.unix_micros("ts") / 1000).cast("long").alias("at_ms"), F.unix_micros("ts").alias("at_us"), F.col(event).alias("event"), F.col("event_id").cast("long").alias("event_id"))
    schema = T.StructType([T.StructField(key, events.schema[key].dataType), T.StructField("at_ms", T.LongType()), T.StructField("at_us", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("was", T.StringType()), T.StructField("now", T.StringType())])
    return rows.groupBy(key).transformWithStateInPandas(Machine(rules, key), schema, "Append", "EventTime")


def current(moves: DataFrame, key: str) -> DataFrame:
    """(key, state, since_ms, moves): where each key stands after its transitions."""
    last = F.struct("at_ms", F.col("event_id").isNotNull(), "at_us", "event_id")
    return moves.groupBy(key).agg(F.max_by("now", last).alias("state"), F.max("at_ms").alias("since_ms"), F.count("*").alias("moves"))


def folded(events: list[tuple[int, int, str]], rules: Rules, until: int) -> list[tuple]:
    """The transitions of one key's events (time, id, event), all at once; timeouts up to until."""
    state, since, steps = rules.start, 0, []
    for at, number, event in sorted(events):
        for end, was, after in list(rules.expired(state, since, at)):
            steps.append((end, None, was, after))
            state, since = after, end
        if (after := rules.transitions.get((state, event))) is not None:
            steps.append((at, number, state, after))
            state, since = after, at
    for end, was, after in list(rules.expired(state, since, until)):
        steps.append((end, None, was, after))
    return steps


def stream_of(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream over the Parquet files that are put into folder."""
    return spark.readStream.schema(schema).parquet(folder)
