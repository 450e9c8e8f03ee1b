"""Batch requests to a classifier: prompts, token counts, costs and the spending plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.functions import text as tx
from convroute.operators.context import context_block

# --- Fixed values: prompt format -----------------------------------------------------------------
EMPTY_MESSAGE = "(empty message)"
OUTPUT_TOKENS_PER_MESSAGE = 10
CHARS_PER_TOKEN = 4

# Requests in one Arrow batch.
ARROW_ROWS = 64

MEMBER_COLUMNS = ("id", "thread_idx", "seed_id", "turn_index", "platform", "author", "asked")


@dataclass(frozen=True)
class Reply:
    """What a classifier returns for one batch: a JSON array of {i, label, conf}, and token counts."""

    body: str
    prompt_tokens: int = 0
    output_tokens: int = 0
    thinking_tokens: int = 0


# Called once per Python worker; returns a function from (prompt, texts of the batch) to a Reply.
ClassifierFactory = Callable[[], Callable[[str, Sequence[str]], Reply]]


def question(config: RoutingConfig) -> Column:
    """What is asked about one message.  Only the message is cut to length, never its context."""
    message = F.substring(
        F.regexp_replace(tx.strip(F.col("text")), "\n", " "), 1, config.max_message_chars
    )
    shown = F.when(message == "", F.lit(EMPTY_MESSAGE)).otherwise(message)
    return F.concat(F.lit("context: "), context_block(F.col("context")), F.lit("\n    message: "), shown)


def with_asked(messages: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Add ``asked``, a hash of the question: an answer holds for a message only while its question is the same."""
    return messages.withColumn("asked", F.sha2(question(config), 256))


def prompt_line(config: RoutingConfig) -> Column:
    """The lines of one message."""
    return F.concat(F.lit("["), F.col("local_i"), F.lit("] "), question(config))


def build_requests(batched: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """One row per batch: ``batch, n_messages, prompt, texts, members``.

    A batch holds at most ``batch_size`` messages, which bounds what a group collects.
    """
    member = F.struct(*[F.col(c) for c in MEMBER_COLUMNS])
    entry = F.struct("local_i", prompt_line(config).alias("line"), "text", member.alias("member"))
    grouped = with_asked(batched, config).groupBy("batch").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return grouped.select(
        "batch",
        F.size("entries").alias("n_messages"),
        F.concat(
            F.lit("Classify these "), F.size("entries"), F.lit(" messages:\n\n"),
            F.array_join(F.col("entries.line"), "\n"),
        ).alias("prompt"),
        F.col("entries.text").alias("texts"),
        F.col("entries.member").alias("members"),
    )


def estimate_tokens(requests: DataFrame) -> DataFrame:
    """Token counts to plan with before a classifier has run."""
    return requests.withColumns(
        {
            "prompt_tokens": F.floor(F.length("prompt") / CHARS_PER_TOKEN).cast("bigint"),
            "output_tokens": (F.col("n_messages") * OUTPUT_TOKENS_PER_MESSAGE).cast("bigint"),
            "thinking_tokens": F.lit(0).cast("bigint"),
        }
    )


def with_cost(calls: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Add ``cost`` in USD from ``model`` and the token counts, as an exact decimal.

    The price table has one row per model name known to the configuration, so it is broadcast; other
    models take the default price.
    """
    priced = F.array(*[F.struct(*map(F.lit, row)) for row in config.prices]).cast(
        "array<struct<model:string,price_in:string,price_out:string>>"
    )
    prices = calls.sparkSession.range(1).select(F.inline(priced))
    default_in, default_out = config.default_price

    def per_token(column: str, default: str) -> Column:
        return F.coalesce(F.col(column), F.lit(default)).cast("decimal(12,6)")

    billed_out = F.col("output_tokens") + F.coalesce("thinking_tokens", F.lit(0))
    usd_per_million = F.col("prompt_tokens").cast("decimal(18,0)") * per_token("price_in", default_in) + billed_out.cast(
        "decimal(18,0)"
    ) * per_token("price_out", default_out)
    return (
        calls.join(F.broadcast(prices), "model", "left")
        .withColumn("cost", (usd_per_million * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(28,12)"))
        .drop("price_in", "price_out")
    )


def cost_meter(calls: DataFrame, config: RoutingConfig = RoutingConfig()) -> DataFrame:
    """Calls, tokens and cost per model."""
    return (
        with_cost(calls, config)
        .groupBy("model")
        .agg(
            F.count("*").alias("calls"),
            F.sum("prompt_tokens").alias("in_tok"),
            F.sum(F.col("output_tokens") + F.coalesce("thinking_tokens", F.lit(0))).alias("out_tok"),
            F.sum("cost").cast("double").alias("cost"),
        )
    )


_PLAN_BLOCK = 65_536


def budget_plan(
    calls: DataFrame, config: RoutingConfig = RoutingConfig(), spent_usd: str = "0", block: int = _PLAN_BLOCK
) -> DataFrame:
    """Add ``spent_before`` and ``runs``: a batch runs while spending before it is under the budget.

    The running sum goes over blocks of consecutive batches first (one row per block) and then inside each
    block, so no task sees more than one block or the table of block sums.
    """
    costed = with_cost(calls, config).withColumn("__block", F.floor(F.col("batch") / block).cast("bigint"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    block_sums = costed.groupBy("__block").agg(F.sum("cost").alias("__sum"))
    block_start = block_sums.select(
        "__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("__block").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    spent = (
        F.lit(spent_usd).cast("decimal(28,12)")
        + F.col("__start")
        + F.coalesce(F.sum("cost").over(inside), F.lit(0))
    )
    return (
        costed.join(block_start, "__block")
        .withColumn("spent_before", spent.cast("decimal(38,12)"))
        .withColumn("runs", F.col("spent_before") < F.lit(config.budget_usd).cast("decimal(28,12)"))
        .drop("__block", "__start")
    )


REPLY_TYPE = "struct<body:string,prompt_tokens:bigint,output_tokens:bigint,thinking_tokens:bigint,error:string>"


def call_tasks(batches: int, config: RoutingConfig = RoutingConfig()) -> int:
    """Tasks for so many calls."""
    return max(1, -(-batches // config.calls_per_task))


def classify_requests(requests: DataFrame, factory: ClassifierFactory, tasks: int | None = None) -> DataFrame:
    """Call the classifier once per batch: ``batch, n_messages, members`` and the reply.

    Only prompt and texts go to Python, and neither is in the result.  A call that raises leaves a null body and its
    error, and the rest of the run goes on.  Store the result before using it twice: calls cost money and may vary.
    Store it with few ``arrow_rows``, since a request carries the text of a whole batch and its context.  ``tasks``
    spreads the calls (see ``call_tasks``); None keeps the partitions as they are.
    """

    @F.pandas_udf(REPLY_TYPE)
    def replied(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        classify = factory()
        for prompts, texts in columns:
            out = []
            for prompt, batch_texts in zip(prompts, texts):
                try:
                    r = classify(prompt, list(batch_texts))
                    out.append((r.body, r.prompt_tokens, r.output_tokens, r.thinking_tokens, None))
                except Exception as e:  # noqa: BLE001 - a failed batch must not fail the job
                    out.append((None, 0, 0, 0, str(e)))
            yield pd.DataFrame(
                out, columns=["body", "prompt_tokens", "output_tokens", "thinking_tokens", "error"]
            )

    replied = replied.asNondeterministic()
    # Ranges of batches: each task has about as many calls.
    spread = requests.repartitionByRange(tasks, "batch") if tasks and tasks > 1 else requests
    kept = [c for c in requests.columns if c not in ("prompt", "texts")]
    return spread.withColumn("__reply", replied("prompt", "texts")).select(*kept, "__reply.*")
