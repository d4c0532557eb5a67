"""Late or corrected base rows: recompute the features they influence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from aerolith.plans.series import merge_series


def correct_features(batch: DataFrame, table: str, root: str, base_columns: Sequence[str], tz: str | None = None) -> bool:
    """Merge changed base rows into a series table and refresh the rows they influence."""
    return merge_series(batch, table, root, base_columns, tz)


def correct_from_stream(
    changes: DataFrame, table: str, root: str, base_columns: Sequence[str], checkpoint: str, tz: str | None = None
):
    """Apply ``correct_features`` to every batch of a stream of base rows, in whatever order they come."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        correct_features(batch, table, root, base_columns, tz)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
