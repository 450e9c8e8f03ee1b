"""Prior turns of a message, for messages that arrive as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from convroute.config import RoutingConfig

FIRST_MESSAGE = "(first message in thread)"


def prior_turns(ordered: WindowSpec, turns: int, at_home: Column) -> Column:
    """The lines of the ``turns`` turns before each one, over a window of one chunk in order of turns.

    A turn that is ``at_home`` in the chunk and doesn't follow the one before it fails the job.
    """
    line = F.concat(F.coalesce("author", F.lit("None")), F.lit(": "), F.coalesce("text", F.lit("None")))
    found = F.collect_list(line).over(ordered.rangeBetween(-turns, -1))
    if not turns:
        return found
    before = F.coalesce(F.lag("turn_index").over(ordered), F.lit(-1))
    told = F.concat(F.lit("no turn just before "), F.concat_ws(":", "thread_idx", "turn_index"))
    return F.when(at_home & (before != F.col("turn_index") - 1), F.raise_error(told)).otherwise(found)


def with_context(messages: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Add ``context``: the up to ``context_turns`` turns before each message, oldest first, any author.

    Run it before any filter on author.  One shuffle.  Window tasks hold ``chunk_turns`` turns of a
    thread, not the whole thread, so a thread with a large share of all messages is spread out; the last
    turns of a chunk are copied into the next one to serve as context there.  Turns are positions
    (0, 1, 2, ...), so the frame is a range on the position and needs no look beyond the next chunk; a missing or
    repeated turn fails the job instead of losing context.
    """
    turns, size = config.context_turns, config.chunk_turns
    if turns > size:
        raise ValueError("context_turns must not exceed chunk_turns: context comes from the chunk before at most")
    chunk = F.floor(F.col("turn_index") / size).cast("bigint")
    lent = F.col("turn_index") % size >= size - turns
    spread = messages.withColumn("__home", chunk).withColumn(
        "__chunk",
        F.explode(F.when(lent, F.array(F.col("__home"), F.col("__home") + 1)).otherwise(F.array("__home"))),
    )
    at_home = F.col("__chunk") == F.col("__home")
    found = prior_turns(Window.partitionBy("thread_idx", "__chunk").orderBy("turn_index"), turns, at_home)
    return (
        spread.withColumn("context", found)
        .where(at_home)
        .drop("__chunk", "__home")
    )


def context_block(context: Column) -> Column:
    return F.when(F.size(context) == 0, F.lit(FIRST_MESSAGE)).otherwise(F.array_join(context, " | "))
