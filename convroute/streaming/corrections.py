"""Thread summaries that take corrections: a message's later label replaces its earlier one.

State is kept by message: the label that counts now.  Its keys are ``BLOCKS`` blocks, to which threads, or chunks of
``chunk_turns`` turns of longer ones, are dealt by hash, so that Python is called by block and not by thread.  What a
micro-batch changes leaves as signed deltas: the old label of a message less one, the new one plus one.  Deltas of a thread and a
label are summed before they are written, into a folder of the micro-batch that a repeat replaces; the state store goes
back to the same version then, so a repeat changes nothing.  A summary is the sum of all deltas: labels whose count is
above zero are seen.  Sums can be compacted at any time, and be read under any precedence.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from convroute.config import CUSTOMER, LABELS, Precedence, RoutingConfig
from convroute.operators import rollup
from convroute.streaming.folders import numbered_folders

# Keys of the state. A micro-batch rewrites the blocks it touches; another number needs a new checkpoint.
BLOCKS = 4096


def apply_labels(known: dict[str, list], arrivals: list[tuple[int, int, str | None, bool]]) -> Counter:
    """Replace labels in ``known`` (turn: [order, label, low]); returns the signed change by (label, low)."""
    change: Counter = Counter()
    # Of labels that arrive together, the one of the highest order counts; of equal ones the greatest, then the low one.
    best: dict[int, tuple] = {}
    for turn, order, label, low in arrivals:
        best[turn] = max(best.get(turn, (order, "", False)), (order, label or "", low))
    for turn, (order, label, low) in best.items():
        before = known.get(str(turn))
        if before and before[0] > order:
            continue
        if before and before[1]:
            change[before[1], before[2]] -= 1
        if label:
            change[label, low] += 1
        known[str(turn)] = [order, label, low]
    return Counter({key: n for key, n in change.items() if n})


def label_deltas(labelled: DataFrame, order: Column, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """(thread columns, label, n, n_low) signed changes, from a stream of labelled messages.

    ``order`` is a whole number that grows with later passes; a label of lower order than the one that counts is left
    out, and of equal order the later micro-batch wins.  Labels outside the list count as none.
    """
    columns = list(rollup.THREAD_COLUMNS)
    chunk = F.floor(F.col("turn_index") / config.chunk_turns).cast("bigint")
    rows = labelled.where(F.col("author") == CUSTOMER).select(
        F.pmod(F.xxhash64(*columns, chunk), F.lit(BLOCKS)).cast("int").alias("block"),
        # As text, since pandas makes whole numbers beside nulls floating.
        F.to_json(F.struct(*columns)).alias("thread"),
        F.col("turn_index").cast("bigint").cast("string").alias("turn"),
        order.cast("bigint").alias("order"),
        F.when(F.col("label").isin(*LABELS), F.col("label")).alias("label"),
        F.coalesce(F.col("confidence") == "low", F.lit(False)).alias("low"),
    )

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else {}
        arrivals = defaultdict(list)
        for batch in batches:
            values = (batch[name].tolist() for name in ("thread", "turn", "order", "label", "low"))
            for thread, turn, order, label, low in zip(*values, strict=True):
                arrivals[thread].append((int(turn), int(order), label if isinstance(label, str) else None, bool(low)))
        out = [
            (thread, label, n, n if low else 0)
            for thread, its in arrivals.items()
            for (label, low), n in apply_labels(known.setdefault(thread, {}), its).items()
        ]
        state.update((json.dumps(known, separators=(",", ":")),))
        if out:
            yield pd.DataFrame(out, columns=["thread", "label", "n", "n_low"])

    changes = rows.groupBy("block").applyInPandasWithState(
        advance, "thread string, label string, n long, n_low long", "state string", "append", GroupStateTimeout.NoTimeout
    )
    thread_schema = T.StructType([labelled.schema[name] for name in columns])
    return changes.select(F.from_json("thread", thread_schema).alias("thread"), "label", "n", "n_low").select(
        "thread.*", "label", "n", "n_low"
    )


def _summed(deltas: DataFrame) -> DataFrame:
    sums = deltas.groupBy(*rollup.THREAD_COLUMNS, "label").agg(F.sum("n").alias("n"), F.sum("n_low").alias("n_low"))
    return sums.where((F.col("n") != 0) | (F.col("n_low") != 0))


def start_summary_with_corrections(
    labelled: DataFrame, deltas_path: str, checkpoint: str, order: Column | None = None, config: RoutingConfig = RoutingConfig()
) -> StreamingQuery:
    """Keep thread summaries up to date from labels that may be corrected by later ones; see ``read_corrected_summary``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _summed(batch).write.mode("overwrite").parquet(f"{deltas_path}/batch={batch_id}")

    return (
        label_deltas(labelled, F.lit(0) if order is None else order, config)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folders(spark: SparkSession, deltas_path: str) -> tuple[list[str], int]:
    """The latest compacted folder and the batches after it, and the number of the last of all."""
    number = lambda path: int(path.rsplit("=", 1)[1])
    compacted = numbered_folders(spark, deltas_path, "upto")[-1:]
    upto = number(compacted[0]) if compacted else -1
    later = [path for path in numbered_folders(spark, deltas_path, "batch") if number(path) > upto]
    return compacted + later, max([upto, *map(number, later)])


def compact_deltas(spark: SparkSession, deltas_path: str) -> None:
    """Sum the deltas of all finished micro-batches; run it between starts. Readers see it once it is complete."""
    folders, last = _folders(spark, deltas_path)
    if len(folders) > 1:
        _summed(spark.read.parquet(*folders)).write.mode("overwrite").parquet(f"{deltas_path}/upto={last}")


def read_corrected_summary(
    spark: SparkSession, deltas_path: str, precedence: Precedence = Precedence.DOCUMENTED
) -> DataFrame:
    sums = _summed(spark.read.parquet(*_folders(spark, deltas_path)[0]))
    state = sums.groupBy(*rollup.THREAD_COLUMNS).agg(
        F.sum("n").alias("n_customer_messages"),
        F.bit_or(F.when(F.col("n") > 0, rollup.label_bit(F.col("label")))).alias("label_bits"),
        (F.sum("n_low") > 0).alias("low"),
    )
    return rollup.finish_summary(state.where("n_customer_messages > 0"), precedence)
