"""Structured Streaming: file ingest, windows, state and multi-target writes.

Results of aggregating streams go to a change log: every micro-batch writes the
rows it changed to ``<path>/batch_id=<n>`` and a reader takes the latest row per
key. A repeated batch overwrites its own folder, which makes the sink exactly
once, and no batch rewrites rows it did not change.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.cleansing import dedup_latest
from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit

BATCH = "batch_id"
FULL_STATE_EVERY = 50


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def with_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def run_to_end(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; the checkpoint remembers how far it got."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_every(writer: DataStreamWriter, checkpoint: str, interval: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def append_files(stream: DataFrame, path: str, partition_columns: Sequence[str] = ()) -> DataStreamWriter:
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.partitionBy(*partition_columns) if partition_columns else writer


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).foreachBatch(work)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_columns: Sequence[str] = ()) -> None:
    """One folder per batch; partition folders get few, evenly sized files."""
    if partition_columns:
        df = df.hint("rebalance", *partition_columns)
    writer = df.write.mode("overwrite")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def change_log(stream: DataFrame, path: str, mode: str = "update") -> DataStreamWriter:
    return each_batch(stream, lambda df, batch_id: write_batch(df, path, batch_id), mode)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(path)


def read_change_log(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], latest: Sequence[Column] = ()
) -> DataFrame:
    """Latest row per key over all batches, by ``latest`` and then by batch: without an order
    the last batch wins, with one an old row in a later batch does not."""
    rows = read_batches(spark, path, schema)
    return dedup_latest(rows, keys, [*latest, F.desc(BATCH)]).drop(BATCH)


def compact_change_log(
    spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str], latest: Sequence[Column] = ()
) -> None:
    """Latest row per key, written under its own batch to ``target``. A stopped
    stream can go on there with its old checkpoint, since batch numbers only grow."""
    last = dedup_latest(read_batches(spark, path, schema), keys, [*latest, F.desc(BATCH)])
    last.hint("rebalance").write.mode("errorifexists").partitionBy(BATCH).parquet(target)


def tumbling(stream: DataFrame, ts: str, width: str, delay: str, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates per fixed window; partial aggregation happens before the state store."""
    return sliding(stream, ts, width, width, delay, keys, aggregates)


def sliding(
    stream: DataFrame, ts: str, width: str, slide: str, delay: str, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    window = F.window(ts, width) if slide == width else F.window(ts, width, slide)
    grouped = stream.withWatermark(ts, delay).groupBy(window.alias("w"), *keys).agg(*aggregates)
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *[c for c in grouped.columns if c != "w"],
    )


def sessions(stream: DataFrame, ts: str, gap: str, delay: str, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    grouped = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(*aggregates)
    return grouped.select(
        F.col("w.start").alias("session_start"),
        F.col("w.end").alias("session_end"),
        *[c for c in grouped.columns if c != "w"],
    )


def dedup_stream(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """First event per idempotency key while the key is inside the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Last known values per key, by event time."""
    last = F.max_by(F.struct(*order, *columns), F.struct(*order)).alias("_last")
    grouped = stream.groupBy(*keys).agg(last)
    return grouped.select(*keys, "_last.*")


def stream_merge(stream: DataFrame, path: str, keys: Sequence[str], latest: Sequence[Column]) -> DataStreamWriter:
    """Upsert every micro-batch into the keyed table at ``path``; read it with ``read_change_log``
    and the same ``latest``."""

    def upsert(df: DataFrame, batch_id: int) -> None:
        write_batch(dedup_latest(df, keys, latest), path, batch_id)

    return each_batch(stream, upsert)


def stream_route(stream: DataFrame, routes: Mapping[str, tuple[Column, str]]) -> DataStreamWriter:
    """Write each row to every target whose rule it meets; ``routes`` is ``{name: (rule, path)}``."""

    def route(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for rule, path in routes.values():
                write_batch(df.filter(rule), path, batch_id)
        finally:
            df.unpersist()

    return each_batch(stream, route)


def split_late(stream: DataFrame, ts: str, delay: str, root: str) -> DataStreamWriter:
    """Keep events by event date and put those that come too late aside.

    Too late means older than the highest time of earlier batches minus ``delay``.
    ``root/on_time`` and ``root/late`` get the rows, ``root/high`` one row per batch.
    """

    def split(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        kind = df.schema[ts].dataType
        high_schema = T.StructType([T.StructField("high", kind)])
        df.persist()
        try:
            write_batch(df.agg(F.max(ts).alias("high")), f"{root}/high", batch_id)
            earlier = read_batches(spark, f"{root}/high", high_schema).filter(F.col(BATCH) < batch_id)
            high = earlier.agg(F.max("high").alias("h")).first().h
            if high is None:
                late = F.lit(False)
            else:
                late = F.coalesce(F.col(ts) < F.lit(high).cast(kind) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            write_batch(df.filter(late), f"{root}/late", batch_id)
            dated = df.filter(~late).withColumn("event_date", F.col(ts).cast("date"))
            write_batch(dated, f"{root}/on_time", batch_id, ["event_date"])
        finally:
            df.unpersist()

    return each_batch(stream, split)


def threshold_alerts(
    stream: DataFrame,
    device: str,
    ts: str,
    unique: str,
    breached: Column,
    root: str,
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataStreamWriter:
    """One alert when a device's rule becomes breached, none while it stays so.

    The last reading per device is the state. It is kept as a table below
    ``root/state`` instead of a per-device Python state function, so that a
    device with very many readings is still spread over tasks. A batch writes
    the devices it saw, every ``FULL_STATE_EVERY``-th batch all of them, so a
    batch reads a bounded number of state folders. Alerts are below
    ``root/alerts``. Readings must reach the stream in event order, batch by batch.
    """

    def detect(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            alert(df, batch_id)
        finally:
            df.unpersist()

    def alert(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("_breached", F.coalesce(breached, F.lit(False)))
        state_schema = T.StructType([df.schema[device], df.schema[ts], df.schema[unique], T.StructField("_breached", T.BooleanType())])
        known = rows.select(device, ts, unique, "_breached")
        if batch_id > 0:
            full = (batch_id - 1) // FULL_STATE_EVERY * FULL_STATE_EVERY
            log = read_batches(df.sparkSession, f"{root}/state", state_schema)
            log = log.filter((F.col(BATCH) >= full) & (F.col(BATCH) < batch_id))
            seed = dedup_latest(log, [device], [F.desc(BATCH)]).drop(BATCH)
            rows = rows.withColumn("_new", F.lit(True)).unionByName(seed, allowMissingColumns=True)
            if batch_id % FULL_STATE_EVERY == 0:
                known = known.unionByName(seed)
        else:
            rows = rows.withColumn("_new", F.lit(True))
        split = OrderedSplit(rows, [device], [ts, unique], min_piece_rows, max_pieces, weigh=df)
        seen = split.done(split.previous(split.df, {"_was": "_breached"}))
        alerts = seen.filter(F.col("_new") & F.col("_breached") & ~F.coalesce("_was", F.lit(False)))
        write_batch(alerts.select(*df.columns), f"{root}/alerts", batch_id)
        write_batch(dedup_latest(known, [device], [F.desc(ts), F.desc(unique)]), f"{root}/state", batch_id)

    return each_batch(stream, detect)


def hot_cold(
    stream: DataFrame, live: DataFrame, ts: str, root: str, hourly: bool = True
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """Two queries on one source: ``live`` as a change log, every event as history
    by date and, unless switched off, hour."""
    parts = {"event_date": F.col(ts).cast("date")} | ({"event_hour": F.hour(ts)} if hourly else {})
    history, folders = stream.withColumns(parts), list(parts)
    cold = each_batch(history, lambda df, batch_id: write_batch(df, f"{root}/cold", batch_id, folders))
    return change_log(live, f"{root}/hot"), cold
