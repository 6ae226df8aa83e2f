"""Continuous update: new tiles become statistics as they arrive.

No state is kept between batches: a batch only tells which slices changed, and these are computed
anew from all their stored tiles, whichever batches those came in. A batch that is run again after
a failure writes the same rows over themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellwise.schema import TILES


def arriving_tiles(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Tiles of files that appear below a folder."""
    reader = spark.readStream.schema(TILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def touched_slices(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All stored tiles of the slices that a batch has tiles of; null keys are equal."""
    changed = batch.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return stored.join(changed, same, "left_semi")


def keep_updated(
    tiles: DataFrame, handle: Callable[[DataFrame], object], checkpoint: str
) -> StreamingQuery:
    """Run ``handle`` on every batch of arriving tiles until none is left, then stop.

    Run it on a schedule, as the batch update would be; the checkpoint remembers what was done.
    """

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        handle(batch)

    return (
        tiles.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
