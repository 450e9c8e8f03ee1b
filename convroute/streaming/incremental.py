"""Incremental routing with Structured Streaming.

Jobs run with ``availableNow`` by default: start them again whenever new files have arrived and
they continue from their checkpoint.
"""

from __future__ import annotations

import time
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from convroute.config import Precedence, RoutingConfig
from convroute.operators import audits, merge, requests, responses, rollup
from convroute.operators.numbering import assign_batches
from convroute.operators.requests import ClassifierFactory
from convroute.operators.stages import ScorerFactory
from convroute.plans.run import local_stages
from convroute.sinks import keyed_log
from convroute.sinks.result_log import append_slice
from convroute.streaming.context import with_arriving_context
from convroute.streaming.folders import numbered_folders
from convroute.workspace import Workspace


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", max_files: int = 1000
) -> DataFrame:
    """Files below ``path`` as a stream; a trigger takes at most ``max_files`` of them."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(format).load(path)


def start_routing(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    config: RoutingConfig = RoutingConfig(),
    scores: DataFrame | None = None,
    scorer: ScorerFactory | None = None,
) -> StreamingQuery:
    """Label arriving messages by the local stages.  Stateless: each message is judged by itself."""
    staged = local_stages(messages, config, scorer=scorer, scores=scores)
    return (
        staged.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_reported_routing(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    config: RoutingConfig = RoutingConfig(),
    scores: DataFrame | None = None,
    scorer: ScorerFactory | None = None,
) -> StreamingQuery:
    """``start_routing`` that leaves the counts of both reports beside the labels, made by the pass that writes them.

    A micro-batch writes ``labels/batch=<id>``, then one row in ``counts/batch=<id>``; a repeat replaces both.
    """

    def micro_batch(batch: DataFrame, batch_id: int) -> None:
        counts = audits.ReportCounts()
        staged = local_stages(batch, config, scorer=scorer, scores=scores)
        counts.observe(staged).write.mode("overwrite").parquet(f"{out_path}/labels/batch={batch_id}")
        row = counts.table(batch.sparkSession).coalesce(1)
        row.write.mode("overwrite").parquet(f"{out_path}/counts/batch={batch_id}")

    return (
        messages.writeStream.foreachBatch(micro_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_report_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """One row per finished micro-batch of ``start_reported_routing``: for ``counted_distribution`` and ``counted_coverage``."""
    folders = numbered_folders(spark, f"{out_path}/counts", "batch")
    counts = spark.read.schema(audits.COUNTS_SCHEMA)
    return counts.parquet(*folders) if folders else spark.createDataFrame([], audits.COUNTS_SCHEMA)


def start_context(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    config: RoutingConfig = RoutingConfig(),
    wait_ms: int | None = None,
) -> StreamingQuery:
    """Give arriving flat messages their context, as soon as the turns it takes are in; see ``with_arriving_context``.

    With ``wait_ms`` the query goes on until it is stopped, since waiting ends by the clock.
    """
    until_stopped = {"processingTime": f"{max(1, (wait_ms or 0) // 2)} milliseconds"}
    return (
        with_arriving_context(messages, config, wait_ms)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if wait_ms is None else until_stopped))
        .start()
    )


# --- Model stage ----------------------------------------------------------------------------------


def _left_open(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What is left to ask again: the latest round that took the whole queue, and what was put behind it since."""
    number = lambda path: int(path.rsplit("=", 1)[1])
    rounds = numbered_folders(spark, f"{folder}/open", "round")[-1:]
    taken = number(rounds[0]) if rounds else -1
    rounds += [path for path in numbered_folders(spark, f"{folder}/waiting", "round") if number(path) > taken]
    return spark.read.schema(schema).parquet(*rounds) if rounds else spark.createDataFrame([], schema)


def _spent_usd(spark: SparkSession, folder: str) -> Decimal:
    spent = model_costs(spark, folder)
    return Decimal((spent.agg(F.sum("cost")).first()[0] or 0) if spent is not None else 0)


def failed_messages(spark: SparkSession, state_path: str) -> DataFrame | None:
    """Messages given up after ``attempts`` failures, with their errors; None if there are none."""
    rounds = numbered_folders(spark, f"{state_path}/failed", "round")
    return spark.read.option("mergeSchema", True).parquet(*rounds) if rounds else None


def model_costs(spark: SparkSession, state_path: str) -> DataFrame | None:
    """Calls, tokens and cost per model and round."""
    rounds = numbered_folders(spark, f"{state_path}/meter", "round")
    return spark.read.parquet(*rounds) if rounds else None


def start_model_stage(
    open_messages: DataFrame,
    classifier: ClassifierFactory,
    log_path: str,
    checkpoint: str,
    config: RoutingConfig = RoutingConfig(),
    state_path: str | None = None,
) -> StreamingQuery:
    """Classify arriving undecided messages, which carry their context, and append to the result log.

    Every try of a micro-batch writes a slice of its own and asks only what no slice answers, so a repeat after a
    crash neither asks twice nor takes back an answer.  Messages whose call failed or that the budget left out wait
    below ``state_path`` (by default next to the log) and are asked again by the next micro-batch, and by the next
    start even if no file has arrived.  While the budget is spent, a micro-batch only puts its own messages behind
    those that wait: it reads neither them nor the log.  A round that may ask takes the whole queue and writes what it
    leaves.  After ``config.attempts`` failures a message goes to ``failed_messages``.  So every message is in the
    log, waiting, or visibly failed.  ``model_costs`` has the calls and costs; no round starts once they have reached
    the budget.  Slices are merged into the keyed log as they gather (see ``keyed_log``).
    """
    spark = open_messages.sparkSession
    model = config.first_pass_model
    fingerprint = config.fingerprint(model)
    state = state_path or f"{log_path.rstrip('/')}-state"
    stored_schema = T.StructType([*open_messages.schema.fields, T.StructField("attempt", T.IntegerType())])

    def budget_is_spent(own: SparkSession) -> bool:
        return _spent_usd(own, state) >= Decimal(config.budget_usd)

    def classify(batch: DataFrame, slice_name: str, workspace: Workspace) -> None:
        own = batch.sparkSession
        number = time.time_ns()
        arrived = batch.withColumn("attempt", F.lit(0))
        if budget_is_spent(own):
            arrived.write.parquet(f"{state}/waiting/round={number}")
            return
        keyed_log.compact(own, log_path, config.log_buckets, at_least=config.slices_to_merge)
        again = _left_open(own, state, stored_schema)
        both = arrived.unionByName(again.select(*stored_schema.names))
        # A repeated micro-batch meets messages that its first try has left open already.
        both = both.groupBy(*merge.KEY).agg(F.max_by(F.struct(*stored_schema.names), "attempt").alias("m")).select("m.*")
        asked_of = requests.with_asked(both, config)
        todo = workspace.save(keyed_log.pending(asked_of, log_path, fingerprint), "todo")
        n = todo.count()
        batched = assign_batches(todo, config.batch_size, workspace)
        tasks = requests.call_tasks(-(-n // config.batch_size), config)
        called = requests.classify_requests(requests.build_requests(batched, config), classifier, tasks)
        replies = workspace.save(called.withColumn("model", F.lit(model)), "replies", requests.ARROW_ROWS)
        parsed = responses.parse_replies(replies)
        append_slice(responses.merge_replies(parsed), log_path, fingerprint, f"{slice_name}-{number}")
        requests.cost_meter(replies, config).coalesce(1).write.parquet(f"{state}/meter/round={number}")
        lost = parsed.where("not parsed").select(
            F.explode("members").alias("m"), F.coalesce("error", F.lit("unreadable reply")).alias("error")
        )
        failed = todo.drop("asked").join(lost.select("m.thread_idx", "m.turn_index", "error"), list(merge.KEY))
        failed = workspace.save(failed.withColumn("attempt", F.col("attempt") + 1), "failed")
        given_up = F.col("attempt") >= config.attempts
        failed.where(given_up).write.parquet(f"{state}/failed/round={number}")
        failed.where(~given_up).drop("error").write.parquet(f"{state}/open/round={number}")

    def micro_batch(batch: DataFrame, batch_id: int) -> None:
        workspace = Workspace(batch.sparkSession, f"stream-{batch_id}")
        try:
            classify(batch, f"stream-{batch_id}", workspace)
        finally:
            workspace.drop()

    if not budget_is_spent(spark) and not _left_open(spark, state, stored_schema).isEmpty():
        workspace = Workspace(spark, "stream-start")
        try:
            classify(spark.createDataFrame([], open_messages.schema), "start", workspace)
        finally:
            workspace.drop()
    return (
        open_messages.writeStream.foreachBatch(micro_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --- Thread summary -------------------------------------------------------------------------------


def start_thread_summary(labelled: DataFrame, partials_path: str, checkpoint: str) -> StreamingQuery:
    """Keep thread summaries up to date without streaming state.

    Each micro-batch writes the mergeable state of the threads it touched into a folder of its own, which
    a repeat replaces.  ``read_thread_summary`` merges these rows; nothing grows with the number of threads
    in memory.  Rows are labels under no precedence, so they can be read under any.  Every message may arrive once;
    for labels that are corrected later, see ``corrections.start_summary_with_corrections``.
    """

    def write_partials(batch: DataFrame, batch_id: int) -> None:
        rollup.partial_summary(batch).write.mode("overwrite").parquet(f"{partials_path}/batch={batch_id}")

    return (
        labelled.writeStream.foreachBatch(write_partials)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _partials(spark: SparkSession, partials_path: str) -> tuple[list[str], int]:
    """The latest compacted folder and the batches after it, and the number of the last of all."""
    number = lambda path: int(path.rsplit("=", 1)[1])
    compacted = numbered_folders(spark, partials_path, "upto")[-1:]
    upto = number(compacted[0]) if compacted else -1
    later = [path for path in numbered_folders(spark, partials_path, "batch") if number(path) > upto]
    return compacted + later, max([upto, *map(number, later)])


def compact_partials(spark: SparkSession, partials_path: str) -> None:
    """Merge the partial rows of all finished micro-batches into one row per thread.

    Run it between starts of ``start_thread_summary``.  Readers see the merged folder once it is complete; what it
    replaces may be deleted after that, and is not read any more.
    """
    folders, last = _partials(spark, partials_path)
    if len(folders) > 1:
        merged = rollup.merge_partials(spark.read.parquet(*folders))
        merged.write.mode("overwrite").parquet(f"{partials_path}/upto={last}")


def read_thread_summary(
    spark: SparkSession, partials_path: str, precedence: Precedence = Precedence.DOCUMENTED
) -> DataFrame:
    folders, _ = _partials(spark, partials_path)
    return rollup.finish_summary(rollup.merge_partials(spark.read.parquet(*folders)), precedence)
