"""Near-real-time upkeep of the current-day tables with Structured Streaming.

Every micro-batch becomes one merge into a new version of the table whose number is the batch
id, so a batch that is replayed after a failure starts from the same rows and gives the same
table. A bucketed table rewrites only what the batch touches, a snapshot table all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.functions.times import in_session
from marketlake.operators.buckets import BucketedTable
from marketlake.operators.latest import latest_per_key
from marketlake.operators.merge import merge_upsert
from marketlake.operators.quality import current_day_sanity, require
from marketlake.operators.snapshots import Snapshots
from marketlake.plans.metrics import refresh_metrics
from marketlake.sources.payloads import explode_bars

SEED_VERSION = -1


def price_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landing folder of current-day records as an unbounded source."""
    reader = spark.readStream.schema(schemas.CURRENT_DAY)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", True).parquet(path)


def price_documents(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landing folder of JSON payloads, one document per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "payload")


def session_only(records: DataFrame, ts: str = "last_updated_ts") -> DataFrame:
    return records.where(in_session(F.col(ts)))


def _start(
    source: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    """``interval`` such as '5 minutes' polls; without it, what has landed is drained once."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                apply(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        source.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_upserts(
    records: DataFrame,
    table: Snapshots | BucketedTable,
    checkpoint: str,
    newer_only: bool = False,
    min_rows: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Upsert the latest record per ticker and date of each batch into ``table``, which
    holds a seed snapshot. By default the last batch wins; ``newer_only`` keeps a stored
    row that is newer than the incoming one. ``min_rows`` checks the date
    before a batch's snapshot is published.
    """
    keys, ts = ["ticker", "trade_date"], "last_updated_ts"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, keys, ts)

        def enough(merged: DataFrame) -> None:
            day = batch.agg(F.max("trade_date")).scalar()
            require(current_day_sanity(merged, day, min_rows))

        def merged(target: DataFrame) -> DataFrame:
            return merge_upsert(target, latest, keys, newer_only=ts if newer_only else None)

        table.change(batch_id, batch, merged, check=None if min_rows is None else enough)

    return _start(records, upsert, checkpoint, interval)


def start_metrics(
    documents: DataFrame, table: Snapshots | BucketedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Update prices and metrics of known tickers from payload documents."""

    def update(batch: DataFrame, batch_id: int) -> None:
        prices = latest_per_key(explode_bars(batch), ["ticker"], "last_updated_ts")
        table.change(batch_id, prices, lambda target: refresh_metrics(target, prices))

    return _start(documents, update, checkpoint, interval)


def run_for(query: StreamingQuery, minutes: float) -> None:
    """Let a polling query run for a session, then stop it."""
    if not query.awaitTermination(int(minutes * 60)):
        query.stop()
