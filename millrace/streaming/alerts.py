"""Alerts with keyed state: one for each breach of a device, however its readings are delivered."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.session import SETTINGS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
READING = ["device", "at", "unique", "breached", "payload"]
#: Devices are dealt to so many state rows, each with the readings of its devices. A stream keeps the number it began with.
SHARDS = 256


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB, whatever store the session was built with.

    A stream that begins here gets no more state partitions than there are cores (eight at least), and keeps that number: each
    task of each batch starts a Python worker, which takes longer than the readings of a small partition."""
    parts = min(int(spark.conf.get(PARTITIONS)), max(spark.sparkContext.defaultParallelism, 8))
    before = {name: spark.conf.get(name, None) for name in (PROVIDER, PARTITIONS)}
    spark.conf.set(PROVIDER, SETTINGS[PROVIDER])
    spark.conf.set(PARTITIONS, str(parts))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _packed(frame: pd.DataFrame) -> tuple[bytes]:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(packed: tuple) -> pd.DataFrame:
    with pa.ipc.open_stream(bytes(packed[0])) as reader:
        return reader.read_all().to_pandas()


class Breaches(StatefulProcessor):
    """State of a shard of devices: readings that the watermark has not passed yet, and the last one of each device that it has.

    Readings are kept as packed frames and compared column by column, so the work for one is the same in a shard of few devices
    as in one of many. A timer stands at the earliest waiting reading. When the watermark passes it, all readings up to the
    watermark are final: they are put in order and compared with the one before of the same device. A device that is silent for
    ``idle`` microseconds is forgotten; a timer does that, and the comparison does it where the next reading comes before the
    timer.
    """

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packed binary")
        self.last = handle.getValueState("last", "packed binary")
        self.timer = handle.getValueState("timer", "ms long")

    def _wake(self, at: int | None) -> None:
        """Keep one timer: the earliest moment at which something has to be done."""
        was = self.timer.get()[0] if self.timer.exists() else None
        ms = None if at is None else -(-at // 1000)
        if ms != was:
            if was is not None:
                self.handle.deleteTimer(was)
            if ms is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(ms)
                self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            if len(frame):
                self.waiting.appendValue(_packed(frame[READING]))
                low = int(frame["at"].min())
                first = low if first is None else min(first, low)
        was = self.timer.get()[0] * 1000 if self.timer.exists() else None
        if first is not None and (was is None or first < was):
            self._wake(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        readings = [_unpacked(r) for r in self.waiting.get()] if self.waiting.exists() else []
        readings = pd.concat(readings, ignore_index=True) if readings else pd.DataFrame(columns=READING)
        ripe = readings["at"] <= mark
        final, rest = readings[ripe], readings[~ripe]
        last = _unpacked(self.last.get()) if self.last.exists() else None
        alerts = None
        if len(final):
            alerts, last = self._compared(final, last)
            self.waiting.clear()
            if len(rest):
                self.waiting.put([_packed(rest)])
        self.timer.clear()  # it has gone off
        if last is not None:
            last = last[last["at"] + self.idle > mark]
            if len(last):
                self.last.update(_packed(last))
            else:
                self.last.clear()
        ends = ([int(rest["at"].min())] if len(rest) else []) + ([int(last["at"].min()) + self.idle] if last is not None and len(last) else [])
        self._wake(min(ends, default=None))
        if alerts is not None and len(alerts):
            yield alerts

    def _compared(self, final: pd.DataFrame, last: pd.DataFrame | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The readings that raise an alert, and the last one of each device."""
        rows = final.assign(new=True)
        if last is not None:
            rows = pd.concat([last.assign(new=False), rows], ignore_index=True)
        rows = rows.assign(code=pd.factorize(rows["device"], use_na_sentinel=False)[0])
        rows = rows.sort_values(["code", "new", "at", "unique"], kind="stable", ignore_index=True)
        breached, new = rows["breached"].to_numpy(dtype=bool), rows["new"].to_numpy(dtype=bool)
        at, code = rows["at"].to_numpy(dtype="int64"), rows["code"].to_numpy()
        goes_on = np.zeros(len(rows), dtype=bool)
        goes_on[1:] = (code[1:] == code[:-1]) & breached[:-1] & (at[1:] - at[:-1] <= self.idle)
        ends = np.append(code[1:] != code[:-1], True)
        return rows.loc[new & breached & ~goes_on, ["device", "at", "payload"]], rows.loc[ends, ["device", "at", "breached"]]

    def close(self) -> None:
        pass


def breach_alerts(
    stream: DataFrame, device: str, ts: str, unique: str, breached: Column, delay: str, idle: str, shards: int = SHARDS
) -> DataFrame:
    """The readings at which a device's rule becomes breached: it is, and was not at the reading before, or there was none
    within ``idle``.

    Readings may come in any order within ``delay``; an alert comes out when the watermark has passed its reading, later
    readings than that are dropped by the watermark. Equal times are ordered by ``unique``. A rule that is NULL is not breached.
    A reading without a device belongs to the device NULL, one without a time is left out. A device is of a type that a cast to
    a string and back keeps. State is bounded by the readings of ``delay`` and one row for each device that was heard within
    ``idle``; a hash deals devices to ``shards``, whose readings one call handles together, as calls per device are slow. It needs
    the RocksDB state store: start it in a session of ``build_session``, or inside ``rocksdb_state``.
    """
    others = [c for c in stream.columns if c not in (device, ts)]
    late = F.coalesce(breached, F.lit(False))
    # Names of its own, whatever the stream's are; Spark hands frames over by names without a leading underscore.
    rows = stream.filter(F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(device), F.lit(shards)).alias("shard"), F.col(device).cast("string").alias("device"),
        F.col(ts).alias("time"), F.unix_micros(ts).alias("at"), F.col(unique).alias("unique"),
        late.alias("breached"), F.when(late, F.to_json(F.struct(*others))).alias("payload"),
    ).withWatermark("time", delay)
    since = F.lit("2000-01-01").cast("timestamp")
    span = (F.unix_micros(since + F.expr(f"INTERVAL {idle}")) - F.unix_micros(since)).alias("span")
    micros = stream.sparkSession.range(1).select(span).first()["span"]
    found = rows.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=Breaches(micros), outputStructType="device string, at long, payload string", outputMode="Append", timeMode="EventTime"
    )
    known = F.from_json("payload", T.StructType([stream.schema[c] for c in others]))
    name = F.col("device").cast(stream.schema[device].dataType)
    found = found.select(name.alias("device"), F.timestamp_micros("at").alias("time"), known.alias("known"))
    named = {device: F.col("device"), ts: F.col("time")} | {c: F.col("known")[c] for c in others}
    return found.select(*[named[c].alias(c) for c in stream.columns])
