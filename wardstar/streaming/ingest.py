"""Incremental fact loads from a landing folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..context import BatchContext, utc_now
from ..plans.batch import run_batch
from ..schemas import SOURCE
from ..sources.warehouse import Warehouse


def start_load(
    wh: Warehouse,
    tables: Mapping[str, DataFrame],
    landing: str,
    checkpoint: str,
    as_of: date | None = None,
    started_at: Callable[[], datetime] = utc_now,
    clock: Callable[[], datetime] = utc_now,
    files_per_batch: int | None = None,
    refresh_dimensions: bool = True,
    first_batch: int = 1,
) -> StreamingQuery:
    """Load every encounter file not seen yet, then stop.

    tables holds the nine other source tables. Each micro-batch is one warehouse batch
    numbered by its epoch, from first_batch on. Late encounters are loaded too, and the flags they change are
    repaired. An epoch replayed after a failure finds its batch published and does
    nothing, so every file counts exactly once.
    """
    reader = wh.spark.readStream.schema(SOURCE["encounters"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(rows: DataFrame, epoch: int) -> None:
        batch_id = first_batch + epoch
        if batch_id <= wh.snapshot().batch_id:
            return
        start = started_at()
        ctx = BatchContext(batch_id, as_of or start.date(), start, strict=False, clock=clock)
        # A micro-batch holds only new rows, so it cannot be reconciled with the whole fact.
        run_batch(
            wh, {**tables, "encounters": rows}, ctx, reconcile=False, with_dimensions=refresh_dimensions
        )

    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_available(*args, **kwargs) -> None:
    """start_load and wait until the landing folder is drained."""
    start_load(*args, **kwargs).awaitTermination()
