"""Files as they arrive: a stream of new files, applied to a table exactly once."""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pedalmill.session import checkpoint_dir
from pedalmill.sources.store import TableStore
from pedalmill.sources.tables import table


class Progress:
    """What runs have said, the last ``keep`` things; listeners get each as it is said, a failing one is dropped."""

    def __init__(self, keep: int = 200) -> None:
        self.history: deque[dict] = deque(maxlen=keep)
        self.listeners: list[Callable[[dict], None]] = []

    def say(self, **event: object) -> None:
        self.history.append(event)
        for listener in list(self.listeners):
            try:
                listener(event)
            except Exception:  # noqa: BLE001
                self.listeners.remove(listener)


def watch(
    spark: SparkSession, folder: str, schema: StructType, checkpoint: str, apply: Callable[[DataFrame, int], None], glob: str = "*", form: str = "parquet", every: str | None = None, options: dict[str, str] | None = None
) -> StreamingQuery:
    """Give every new file of ``folder`` to ``apply`` once, in batches: those there are and then stop, or
    ``every`` so often (such as '10 seconds'). Writers should put files in place by renaming them."""
    stream = spark.readStream.format(form).schema(schema).option("pathGlobFilter", glob).options(**(options or {})).load(folder)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def upsert_into(store: TableStore, name: str, keys: list[str], order: list[str], progress: Progress | None = None) -> Callable[[DataFrame, int], None]:
    """A function for ``watch`` that upserts batches into a table, the last row by ``order`` winning. A batch that
    is given again after a failure changes nothing."""

    def apply(batch: DataFrame, number: int) -> None:
        rows = batch.select(*batch.columns, F.struct(*order).alias("__order"))
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), "__order").alias("r")).select("r.*")
        if store.exists(name):
            old = store.read(name)
            both = old.unionByName(newest)
            merged = both.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.struct(*order)).alias("r")).select("r.*")
        else:
            merged = newest
        version = store.publish(name, merged)
        if progress:
            progress.say(table=name, batch=number, version=version)

    return apply


def stream_upsert_events(spark: SparkSession, d: str) -> DataFrame:
    """The last event of every user, kept by a stream over the table's files; the batch result."""
    source = table(spark, d, "events")
    at = f"{checkpoint_dir(spark)}/events-{os.urandom(6).hex()}"
    store = TableStore(spark, f"{at}/tables")
    q = watch(spark, d, source.schema, f"{at}/state", upsert_into(store, "last_event", ["user_id"], ["ts", "event_id"]), glob="events.parquet")
    q.awaitTermination()
    return store.read("last_event").select("user_id", "event_id", "event_type", "ts")


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per type and window; as a stream, windows end when the watermark ``late`` behind has passed them."""
    t = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return t.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).cast("double").alias("total")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total"
    )


def events_windowed(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(table(spark, d, "events"))


QUERIES = {"stream_upsert_events": stream_upsert_events, "events_windowed": events_windowed}

ORACLES = {
    "stream_upsert_events": "select user_id, event_id, event_type, ts from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) x where r = 1",
    "events_windowed": "select date_trunc('day', ts)::timestamp as window_start, event_type, count(*) as n, sum(value::decimal(15,2))::double as total from events group by 1, 2",
}
