"""Dense global positions without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convroute.workspace import Workspace

_ROW = "__row"
_FIRST = "__first_row"
_OFFSET = "__offset"
# Spark's monotonically_increasing_id keeps the row number within a task in its lower 33 bits.
_ROW_BITS = 33


def dense_positions(
    df: DataFrame, group: Sequence[str], position: str, workspace: Workspace, name: str
) -> DataFrame:
    """Number rows 0..n-1 by ``group`` order and, within a group, by the order rows are in now.

    A group's rows must sit together in one task (a sorted partition).  The rows are stored
    once with their row marker, because a marker must not change when a lost task runs again; the offsets
    then come from one count per group, so the bulk of the data is not shuffled for numbering.
    """
    stored = workspace.save(df.withColumn(_ROW, F.monotonically_increasing_id()), name)
    per_group = stored.groupBy(*group).agg(F.count("*").alias("__rows"), F.min(_ROW).alias(_FIRST))
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_group.select(
        *[F.col(g).alias(f"__{g}") for g in group],
        _FIRST,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(_OFFSET),
    )
    offsets = workspace.save(offsets, f"{name}-offsets")
    # One row per partition; Spark picks the join by their size.
    same_group = [F.col(g) == F.col(f"__{g}") for g in group]
    return (
        stored.join(offsets, on=same_group, how="inner")
        .withColumn(position, F.col(_OFFSET) + F.col(_ROW) - F.col(_FIRST))
        .drop(_ROW, _FIRST, _OFFSET, *[f"__{g}" for g in group])
    )


def assign_batches(
    messages: DataFrame, batch_size: int, workspace: Workspace, name: str = "batched"
) -> DataFrame:
    """Add ``batch`` and ``local_i``: consecutive batches of messages in corpus order.

    A range partitioning on the full key (thread, turn) splits even one huge thread over many tasks.
    """
    ordered = (
        messages.repartitionByRange("thread_idx", "turn_index")
        .sortWithinPartitions("thread_idx", "turn_index")
        .withColumn("__part", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS))
    )
    numbered = dense_positions(ordered, ["__part"], "__position", workspace, name)
    return numbered.select(
        *[c for c in numbered.columns if c not in ("__part", "__position")],
        F.floor(F.col("__position") / batch_size).cast("bigint").alias("batch"),
        (F.col("__position") % batch_size).cast("int").alias("local_i"),
    )
