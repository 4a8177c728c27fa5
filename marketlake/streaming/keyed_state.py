"""The current-day table kept by Spark's own keyed state.

Each (ticker, date) has its newest record in the state store. A micro-batch sends at most one
record per key and task to the state (`_reduced`), however hot a ticker is; the state lets a record
through when it is newer in event time, ties by its values, and only rows that changed leave the
operator. They are merged into the buckets of the table that they touch. Records behind the
watermark are dropped; a key's state goes once the watermark has passed its newest record by
``keep_for``, since no record can reach it any more by then.

State and sink recover together: Spark replays a batch from its checkpoint with the state as it was
before, and the table takes a replayed batch id as a further attempt at the same version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from marketlake import schemas
from marketlake.operators.buckets import BucketedTable
from marketlake.operators.cleaning import value_mark
from marketlake.operators.merge import merge_upsert

KEYS = ("ticker", "trade_date")
TIME = "last_updated_ts"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A record's place in the order of its key: microseconds, then a hash of all values.
_ORDER = ("at_micros", "mark")
_ORDERED = T.StructType([*schemas.CURRENT_DAY.fields, *(T.StructField(c, T.LongType()) for c in _ORDER)])
_VALUES = tuple(c for c in _ORDERED.fieldNames() if c not in KEYS)
_STATE = T.StructType([_ORDERED[c] for c in _VALUES])
_NEVER = -(1 << 62)


def _ordered(records: DataFrame) -> DataFrame:
    """Records with their place in the order. Zone-less times count as UTC, whatever the session's zone."""
    names = schemas.CURRENT_DAY.fieldNames()
    since = F.col(TIME) - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    micros = (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("bigint")
    return records.select(
        *names, F.coalesce(micros, F.lit(_NEVER)).alias("at_micros"), F.shiftright(value_mark(names), 4).cast("bigint").alias("mark")
    )


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest record of each key among the rows of an Arrow batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows.sort_by([(c, "descending") for c in _ORDER])
        places = rows.append_column("place", pa.array(range(len(rows)), type=pa.int64()))
        newest = places.group_by(list(KEYS)).aggregate([("place", "min")])
        yield from rows.take(newest["place_min"]).combine_chunks().to_batches()


class Newest(StatefulProcessor):
    """Keeps the newest record of a key and emits it when it changed."""

    def __init__(self, keep_for: dt.timedelta | None) -> None:
        self.keep_for = keep_for

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", _STATE)

    def _keep(self, record: tuple, timers) -> None:
        self.newest.update(record)
        at_micros = record[_VALUES.index("at_micros")]
        if self.keep_for is None or at_micros == _NEVER:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = at_micros // 1000 + int(self.keep_for.total_seconds() * 1000)
        self.handle.registerTimer(max(due, timers.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = tuple(self.newest.get()) if self.newest.exists() else None
        order = slice(-len(_ORDER), None)
        changed = False
        for row in rows:
            record = tuple(row[c] for c in _VALUES)
            if best is None or record[order] > best[order]:
                best, changed = record, True
        if changed:
            self._keep(best, timerValues)
            yield Row(**dict(zip(KEYS, key)), **dict(zip(_VALUES, best)))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(tuple(initialState[c] for c in _VALUES), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_records(
    records: DataFrame, delay: str = "1 day", keep_for: dt.timedelta | None = None, seed: DataFrame | None = None
) -> DataFrame:
    """The stream of changed rows: for each key, its record whenever a newer one has come. ``seed``
    holds records (one per key) that are known before the first batch."""
    ordered = _ordered(records).withColumn("event_time", F.timestamp_micros("at_micros"))
    # the watermark comes behind the reduction: a record that it drops there had a newer one of its key
    grouped = ordered.mapInArrow(_reduced, ordered.schema).withWatermark("event_time", delay).groupBy(*KEYS)
    initial = None if seed is None else _ordered(seed).groupBy(*KEYS)
    changed = grouped.transformWithState(Newest(keep_for), _ORDERED, "Update", "EventTime", initial)
    return changed.select(*schemas.CURRENT_DAY.fieldNames())


def start_keyed_state(
    records: DataFrame,
    table: BucketedTable,
    checkpoint: str,
    delay: str = "1 day",
    keep_for: dt.timedelta | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep ``table``, which has a seed version, by the newest record per ticker and date. The rows that
    the table held before version 0 are known to the state, so a record older than them changes nothing."""
    spark = records.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)

    def merge(changed: DataFrame, batch_id: int) -> None:
        changed.persist()
        try:
            if not changed.isEmpty():
                table.change(batch_id, changed, lambda rows: merge_upsert(rows, changed, list(KEYS)))
        finally:
            changed.unpersist()

    # Only the first batch takes the seed; once its version has gone, that batch is long done.
    seeded = any(version < 0 for version in table.versions())
    seed = table.read(before=0) if seeded else spark.createDataFrame([], schemas.CURRENT_DAY)
    changes = newest_records(records, delay, keep_for, seed)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    spark.conf.set(setting, PROVIDER)  # the operator needs it; a query keeps the settings that it began with
    try:
        return (
            changes.writeStream.outputMode("update")
            .foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
