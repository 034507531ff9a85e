"""Keeping the name mapping current while raw files arrive.

Every micro-batch runs the same refresh as the batch job: only names without a
stored mapping are worked on. A batch that is replayed after a failure finds
its names already stored and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clearbook.plans.cleaning import refresh_names


def follow_names(raw: DataFrame, mapping_path: str, checkpoint: str) -> StreamingQuery:
    """Refresh the mapping from a stream of raw transactions until all present files are read."""

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        refresh_names(batch, mapping_path)

    return (
        raw.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
