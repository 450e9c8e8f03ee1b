"""Stage 1 (signals and rules) and stage 2 (sentiment) over a table of messages.

Both stages run in one pass over the messages: every row keeps its place and carries the outcome so far,
instead of being split into decided and undecided tables that are read again and joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.config import BRAND, BRAND_LABEL, CUSTOMER, RoutingConfig
from convroute.functions import rules
from convroute.functions import text as tx
from convroute.functions.signals import with_signals

# Messages in one Arrow batch to a scorer.
ARROW_ROWS = 2048

LABEL_COLUMNS = ("label", "confidence", "source", "reason")

# Called once per Python worker; returns a function from texts to (raw label, score) pairs.
ScorerFactory = Callable[[], Callable[[Sequence[str]], Sequence[tuple[str, float]]]]


def route(messages: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Stage 1.  Adds the signals, the four label columns and ``router_reason``.

    Brand rows get their constant label, customer rows the router's outcome or, while undecided, a null
    label; any other author stays without one.  Text of other authors is not searched.  A null text counts
    as '', so attach context before.
    """
    customer = F.col("author") == CUSTOMER
    brand = F.col("author") == BRAND
    filled = messages.withColumn("text", F.coalesce("text", F.lit("")))
    searched = filled.withColumn("__text", F.when(customer, F.col("text")))
    cascade = rules.router_rules(F.col("__text"), config)
    number = F.col("__rule")
    numbered = with_signals(searched, "__text").withColumn("__rule", F.when(customer, cascade.number()))
    settled = cascade.label(number).isNotNull()
    return numbered.withColumns(
        {
            "label": F.when(brand, BRAND_LABEL).otherwise(cascade.label(number)),
            "confidence": F.when(brand, "n/a").when(settled, cascade.confidence(number)),
            "source": F.when(brand, "rule").when(settled, "router"),
            "reason": F.when(brand, "brand_authored_not_a_customer_intent").when(settled, cascade.reason(number)),
            "router_reason": cascade.reason(number),
        }
    ).drop("__text", "__rule")


def is_undecided() -> Column:
    return (F.col("author") == CUSTOMER) & F.col("label").isNull()


def apply_sentiment(routed: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Stage 2, on rows that carry ``sentiment`` and ``score``.  Adds ``sentiment_reason``.

    An undecided row without a score stays undecided.
    """
    tried = is_undecided() & F.col("sentiment").isNotNull()
    cascade = rules.sentiment_rules(F.col("sentiment"), F.col("score"), config)
    number = F.col("__rule")
    numbered = routed.withColumn("__rule", F.when(tried, cascade.number()))
    found = cascade.label(number).isNotNull()
    reason = cascade.reason(number, F.col("score"))
    return numbered.withColumns(
        {
            "label": F.coalesce("label", cascade.label(number)),
            "confidence": F.when(found, cascade.confidence(number)).otherwise(F.col("confidence")),
            "source": F.when(found, "sentiment").otherwise(F.col("source")),
            "reason": F.when(found, reason).otherwise(F.col("reason")),
            "sentiment_reason": reason,
        }
    ).drop("__rule")


def join_scores(routed: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach scores kept in a table ``(thread_idx, turn_index, sentiment, score)``."""
    keyed = scores.select("thread_idx", "turn_index", "sentiment", "score")
    return routed.join(keyed, ["thread_idx", "turn_index"], "left")


def score_texts(routed: DataFrame, factory: ScorerFactory) -> DataFrame:
    """Attach scores from an injected scorer, for undecided rows only.

    Only the text of undecided rows is sent to Python (a null otherwise), in Arrow batches and within the
    same pass; the scorer is made once per Python worker.  A blank text is scored as ".".
    """

    @F.pandas_udf("struct<raw_label:string,score:double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = factory()
        for texts in batches:
            out = pd.DataFrame({"raw_label": None, "score": float("nan")}, index=texts.index, dtype="object")
            wanted = texts.dropna()
            if len(wanted):
                pairs = score(list(wanted))
                out.loc[wanted.index, "raw_label"] = [label for label, _ in pairs]
                out.loc[wanted.index, "score"] = [float(value) for _, value in pairs]
            yield out.astype({"score": "float64"})

    scored = scored.asNondeterministic()
    wanted = F.when(tx.is_blank(F.col("text")), F.lit(".")).otherwise(F.col("text"))
    with_raw = routed.withColumn("__scored", scored(F.when(is_undecided(), wanted)))
    raw_label = F.col("__scored.raw_label")
    return with_raw.withColumns(
        {
            "sentiment": F.when(raw_label.isNotNull(), rules.normalised_sentiment(raw_label)),
            "score": F.when(raw_label.isNotNull(), F.col("__scored.score")),
        }
    ).drop("__scored")


def without_signals(df: DataFrame) -> DataFrame:
    return df.drop(*lx.SIGNALS)
