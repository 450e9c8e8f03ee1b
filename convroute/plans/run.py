"""A whole run: stages, classifier pass, optional refinement, merged labels and reports."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.operators import audits, merge, requests, responses, rollup, stages
from convroute.operators.numbering import assign_batches
from convroute.operators.requests import ClassifierFactory
from convroute.operators.stages import ScorerFactory
from convroute.sinks import keyed_log
from convroute.sinks.result_log import append_slice
from convroute.sources.threads import first_threads
from convroute.workspace import Workspace


@dataclass(frozen=True)
class ModelPass:
    """What one classifier pass did: rows, replies (None without calls), money spent so far, and requests."""

    rows: DataFrame
    replies: DataFrame | None
    spent_usd: Decimal
    requests: DataFrame

    @property
    def failed_batches(self) -> DataFrame:
        """``batch, n_messages, error``: batches whose call failed or whose reply is not JSON."""
        if self.replies is None:
            return self.requests.limit(0).select("batch", "n_messages", F.lit("").alias("error"))
        parsed = responses.parse_replies(self.replies).where("not parsed")
        return parsed.select("batch", "n_messages", F.coalesce("error", F.lit("unreadable reply")).alias("error"))

    @property
    def unrun_batches(self) -> DataFrame:
        """``batch, n_messages``: batches that the budget left out."""
        asked = self.requests.select("batch", "n_messages")
        return asked if self.replies is None else asked.join(self.replies.select("batch"), "batch", "left_anti")


@dataclass(frozen=True)
class RoutingRun:
    """Results of a run.  ``passes`` tell what it did not finish; see ``unfinished``.

    ``counts`` are those of the reports, made by the pass that wrote the final labels.
    """

    labelled: DataFrame
    counts: audits.ReportCounts
    cost_meter: DataFrame | None
    config: RoutingConfig
    workspace: Workspace
    passes: tuple[ModelPass, ...]

    @property
    def unfinished(self) -> DataFrame:
        """``pass_no, batch, n_messages, error``: failed batches with their errors, unrun ones with a null."""
        parts = []
        for number, done in enumerate(self.passes):
            parts += [
                done.failed_batches.withColumn("pass_no", F.lit(number)),
                done.unrun_batches.withColumns({"error": F.lit(None).cast("string"), "pass_no": F.lit(number)}),
            ]
        return reduce(DataFrame.unionByName, parts).select("pass_no", "batch", "n_messages", "error")

    @property
    def labels(self) -> DataFrame:
        return merge.labels_output(self.labelled)

    @property
    def thread_summary(self) -> DataFrame:
        return rollup.thread_summary(self.labelled, self.config.precedence)

    @property
    def label_distribution(self) -> DataFrame:
        return self.counts.label_distribution(self.labelled.sparkSession)

    @property
    def stage_coverage(self) -> DataFrame:
        return self.counts.stage_coverage(self.labelled.sparkSession)


def local_stages(
    messages: DataFrame,
    config: RoutingConfig = RoutingConfig(),
    scorer: ScorerFactory | None = None,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Stage 1 and, with a scorer or a table of scores, stage 2.  One pass; signals are dropped."""
    staged = stages.route(messages, config)
    if scores is not None:
        staged = stages.join_scores(staged, scores)
    elif scorer is not None:
        staged = stages.score_texts(staged, scorer)
    if "sentiment" in staged.columns:
        staged = stages.apply_sentiment(staged, config)
    return stages.without_signals(staged)


def _next_slice(left_usd: Decimal, cost_per_batch: Decimal, config: RoutingConfig) -> int:
    """Batches whose cost, at what batches have cost so far, takes half of the money left."""
    if cost_per_batch <= 0:
        return config.most_slice
    return max(1, min(config.most_slice, int(left_usd / (2 * cost_per_batch))))


def model_pass(
    todo: DataFrame,
    classifier: ClassifierFactory,
    model: str,
    source: str,
    log_path: str,
    config: RoutingConfig,
    workspace: Workspace,
    spent_usd: Decimal = Decimal(0),
) -> ModelPass:
    """Classify messages in batches.

    Messages whose question is already answered in the log under the same settings are not asked again, and only
    answers to these messages are returned.  Calls run in slices of batches, and each is logged before the next
    starts, so a lost job repeats one slice at most.  The first slice is small; each later one is planned to cost
    half of the money left, by the real costs so far.  No slice starts once the budget is spent, so spending
    exceeds it by the cost of one slice at most, and by that of one batch if costs per batch stay the same.
    """
    spark = todo.sparkSession
    fingerprint = config.fingerprint(model, source)
    name = f"{source}-{uuid.uuid4().hex[:8]}"
    asked_of = requests.with_asked(todo, config)
    keyed_log.compact(spark, log_path, config.log_buckets, at_least=config.slices_to_merge)
    open_rows = workspace.save(keyed_log.pending(asked_of, log_path, fingerprint), f"{name}-open")
    batched = assign_batches(open_rows, config.batch_size, workspace, f"{name}-batched")
    asked = workspace.save(
        requests.build_requests(batched, config).repartitionByRange("batch").sortWithinPartitions("batch"),
        f"{name}-requests",
    )
    n_batches = asked.count()

    slices: list[DataFrame] = []
    budget, began, first, size = Decimal(config.budget_usd), spent_usd, 0, config.first_slice
    while first < n_batches and spent_usd < budget:
        size = min(size, n_batches - first)
        part = asked.where(F.col("batch").between(first, first + size - 1))
        called = requests.classify_requests(part, classifier, requests.call_tasks(size, config))
        stored = workspace.save(
            called.withColumn("model", F.lit(model)), f"{name}-replies/slice={len(slices)}", requests.ARROW_ROWS
        )
        rows = responses.merge_replies(responses.parse_replies(stored), source)
        append_slice(rows, log_path, fingerprint, f"{name}-{len(slices):06d}")
        slices.append(stored)
        cost = requests.with_cost(stored, config).agg(F.sum("cost")).first()[0]
        spent_usd += cost or Decimal(0)
        first += size
        size = _next_slice(budget - spent_usd, (spent_usd - began) / first, config)

    # One table of all slices: the plan does not grow with their number.
    replies = spark.read.schema(slices[0].schema).parquet(workspace.folder(f"{name}-replies")) if slices else None
    rows = keyed_log.answered(asked_of, log_path, fingerprint)
    return ModelPass(rows, replies, spent_usd, asked)


def run_routing(
    messages: DataFrame,
    classifier: ClassifierFactory,
    log_path: str,
    config: RoutingConfig = RoutingConfig(),
    scorer: ScorerFactory | None = None,
    scores: DataFrame | None = None,
    refine: bool = False,
    limit: int | None = None,
) -> RoutingRun:
    """Label every message, or those of the first ``limit`` threads.  ``messages`` carry their ``context`` (see ``flatten_threads``/``with_context``).

    Local stages are stored before the classifier pass reads them, so scoring is not repeated; so are the final
    labels, which all reports read.  Context is kept only on rows that may still be sent to a classifier.  Look at
    ``unfinished`` for batches that failed or that the budget left out, and drop ``workspace`` when done.
    """
    spark = messages.sparkSession
    workspace = Workspace(spark, "run")
    staged = local_stages(first_threads(messages, limit), config, scorer, scores)
    may_ask = stages.is_undecided() | (F.col("confidence") == "low")
    staged = staged.withColumn("context", F.when(may_ask, F.col("context")))
    staged = workspace.save(staged, "staged", stages.ARROW_ROWS)

    first = model_pass(
        merge.undecided(staged), classifier, config.first_pass_model, "api", log_path, config, workspace
    )
    passes = [first]
    counts = audits.ReportCounts()
    labelled = workspace.save(counts.observe(merge.attach_labels(staged, first.rows)), "labelled")
    if refine:
        again = model_pass(
            merge.refine_candidates(labelled), classifier, config.refine_model, "api_refine", log_path, config,
            workspace, first.spent_usd,
        )
        passes.append(again)
        counts = audits.ReportCounts()
        labelled = workspace.save(counts.observe(merge.attach_labels(labelled, again.rows)), "refined")
    replies = [done.replies for done in passes if done.replies is not None]
    meter = requests.cost_meter(reduce(DataFrame.unionByName, replies), config) if replies else None
    return RoutingRun(labelled.drop("context"), counts, meter, config, workspace, tuple(passes))
