"""Thread summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute.config import CUSTOMER, LABELS, Precedence

THREAD_COLUMNS = ("thread_idx", "seed_id", "platform", "customer_name")


def label_bit(label: Column) -> Column:
    """One bit per label, by its place in ``LABELS``; null for other labels.  No precedence yet."""
    chain = F
    for place, name in enumerate(LABELS):
        chain = chain.when(label == name, 1 << place)
    return chain


def partial_summary(labelled: DataFrame) -> DataFrame:
    """Mergeable per-thread state: message count, set of labels as bits, any low confidence.

    The state is three fixed-width numbers, so Spark keeps it in a hash map, combines before the shuffle
    and a thread with very many messages costs no more than any other.  The thread's own columns are the
    same on all its messages and serve as keys.  Partials add up: each message may be in one of them only.
    """
    bit = label_bit(F.col("label"))
    low = bit.isNotNull() & (F.col("confidence") == "low")
    state = labelled.where(F.col("author") == CUSTOMER).groupBy(*THREAD_COLUMNS).agg(
        F.count(bit).alias("n_customer_messages"),
        F.bit_or(bit).alias("label_bits"),
        F.max(F.coalesce(low, F.lit(False))).alias("low"),
    )
    return state.where(F.col("n_customer_messages") > 0)


def merge_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*THREAD_COLUMNS).agg(
        F.sum("n_customer_messages").alias("n_customer_messages"),
        F.bit_or("label_bits").alias("label_bits"),
        F.max("low").alias("low"),
    )


def finish_summary(state: DataFrame, precedence: Precedence = Precedence.DOCUMENTED) -> DataFrame:
    seen = [
        F.when(F.col("label_bits").bitwiseAND(1 << LABELS.index(name)) != 0, F.lit(name)) for name in precedence.value
    ]
    return state.select(
        *THREAD_COLUMNS,
        "n_customer_messages",
        F.coalesce(*seen).alias("primary_label"),
        F.concat_ws(", ", *seen).alias("all_labels_seen"),
        F.when(F.col("low"), "yes").otherwise("").alias("has_low_confidence_turn"),
    )


def thread_summary(labelled: DataFrame, precedence: Precedence = Precedence.DOCUMENTED) -> DataFrame:
    """One row per thread with a labelled customer message.  Works on streams too.  Sort at the sink."""
    return finish_summary(partial_summary(labelled), precedence)
