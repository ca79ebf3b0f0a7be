"""Snapshot pages picked up as they land.

The same refresh and upsert as the daily job. The stream's checkpoint remembers which page
files were read, so a run handles exactly the pages that are new. They are held beside the
checkpoint, by batch, until all pages of the snapshot have landed: half a snapshot publishes
nothing, the batch that completes it publishes it once. A page that lands again replaces the one
held. The day of a batch is written beside the checkpoint before its first attempt, so a batch
replayed after midnight gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StreamingQuery

from reelmill.plans import clean, jobs
from reelmill.sources import schemas
from reelmill.sources.files import (
    films_of_pages, newest_snapshot, scan_external_ids, scan_genre_dim,
)
from reelmill.sources.store import TableStore


def utc_today() -> date:
    return datetime.now(timezone.utc).date()


def day_of_batch(store: TableStore, path: str, run_date: Callable[[], date]) -> date:
    """The day stored at ``path``, or else ``run_date`` after storing it there."""
    stored = store.spark.createDataFrame([(run_date(),)], "day date").coalesce(1)
    stored.write.mode("ignore").parquet(path)
    return store.spark.read.schema("day date").parquet(path).first()["day"]


def hold_pages(store: TableStore, batch: DataFrame, folder: str, number: int) -> DataFrame:
    """All pages held, those of this batch included; a replayed batch replaces its pages."""
    batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
    schema = T.StructType([*schemas.PAGE.fields, T.StructField("batch", T.LongType())])
    return store.spark.read.schema(schema).parquet(folder)


def follow_pages(
    store: TableStore,
    landed: jobs.Landed,
    checkpoint: str,
    run_date: Callable[[], date] = utc_today,
    on_duplicate: str = "error",
) -> StreamingQuery:
    """Start a run over all page files not seen before; it stops when they are done."""
    pages = (
        store.spark.readStream.schema(schemas.PAGE)
        .option("mode", "FAILFAST")
        .option("multiLine", landed.multi_line)
        .json(landed.pages)
    )

    def apply(batch: DataFrame, number: int) -> None:
        day = day_of_batch(store, f"{checkpoint}/batch_days/{number}", run_date)
        held = hold_pages(store, batch, f"{checkpoint}/held_pages", number)
        snapshot, complete = newest_snapshot(held)
        if not complete:
            return
        films = clean.now_playing_clean(
            films_of_pages(snapshot),
            scan_genre_dim(store.spark, landed.genres, landed.multi_line),
            scan_external_ids(store.spark, landed.external_ids),
            day,
            landed.fractions,
        )
        store.full_refresh(jobs.NOW_PLAYING_TABLE, films, skip_if_empty=True)
        jobs.upsert_titles(store, on_duplicate)
        store.discard(f"{checkpoint}/held_pages")

    return (
        pages.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
