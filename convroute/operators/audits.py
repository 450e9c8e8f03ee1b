"""Counts over the labelled corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from convroute.config import BRAND, BRAND_LABEL, CUSTOMER, LABELS

#: Every label that rules, classifiers and brand rows can give.
ALL_LABELS = tuple(dict.fromkeys([*LABELS, BRAND_LABEL]))

_COVERAGE = (
    "n_messages", "n_customer", "n_brand", "router_decided", "sentiment_decided", "model_decided", "labelled",
    "low_confidence",
)
COUNTS = (*_COVERAGE, *(f"label_{n}" for n in range(len(ALL_LABELS))))
COUNTS_SCHEMA = ", ".join(f"{name} bigint" for name in COUNTS)


def _with_percent(counts: DataFrame) -> DataFrame:
    # The window runs over one row per label.
    total = F.sum("n_messages").over(Window.partitionBy())
    return counts.withColumn("percent", F.lit(100) * F.col("n_messages") / total).orderBy(
        F.desc("n_messages"), "label"
    )


def label_distribution(labelled: DataFrame) -> DataFrame:
    """Messages per label and their share of all labelled messages, largest first."""
    return _with_percent(
        labelled.where(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n_messages"))
    )


def _coverage_counts() -> list[Column]:
    counted = (
        F.lit(True),
        F.col("author") == CUSTOMER,
        F.col("author") == BRAND,
        F.col("source") == "router",
        F.col("source") == "sentiment",
        F.col("source").isin("api", "api_refine"),
        F.col("label").isNotNull(),
        F.col("confidence") == "low",
    )
    return [F.count_if(test).alias(name) for name, test in zip(_COVERAGE, counted, strict=True)]


def _with_shares(counts: DataFrame) -> DataFrame:
    customers = F.greatest("n_customer", F.lit(1))
    to_model = F.col("n_customer") - F.col("router_decided") - F.col("sentiment_decided")
    return counts.withColumns(
        {
            "to_model": to_model,
            "router_percent": F.lit(100) * F.col("router_decided") / customers,
            "to_model_percent": F.lit(100) * to_model / customers,
        }
    )


def stage_coverage(labelled: DataFrame) -> DataFrame:
    """How many messages each stage decided, and its share of customer messages: one row."""
    return _with_shares(labelled.agg(*_coverage_counts()))


class ReportCounts:
    """Both reports, counted in the pass that writes the labels instead of by reading these again.

    ``observe`` goes on top of what is written, after its sort: counts come from the tasks that write, each partition
    once.  Further down, the sample of a sort or a lost map output would count rows twice.  Call ``row`` (or a report)
    once the write is done.  The counts are one row of fixed width, since labels are of a fixed set; a label outside it
    fails the reports.
    """

    def __init__(self) -> None:
        self._observation = Observation(f"reports-{uuid.uuid4().hex}")

    def observe(self, labelled: DataFrame) -> DataFrame:
        """The same rows, counted while they pass.  For one write; a second one is not counted again."""
        per_label = [F.count_if(F.col("label") == name).alias(f"label_{n}") for n, name in enumerate(ALL_LABELS)]
        return labelled.observe(self._observation, *_coverage_counts(), *per_label)

    @property
    def row(self) -> dict[str, int]:
        # A plan that Spark knows to be empty may come without its counts.
        found = self._observation.get
        return {name: found.get(name) or 0 for name in COUNTS}

    def table(self, spark: SparkSession) -> DataFrame:
        """The counts as one row, which adds up with those of other writes."""
        return spark.createDataFrame([tuple(self.row.values())], COUNTS_SCHEMA)

    def label_distribution(self, spark: SparkSession) -> DataFrame:
        return counted_distribution(self.table(spark))

    def stage_coverage(self, spark: SparkSession) -> DataFrame:
        return counted_coverage(self.table(spark))


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS])


def counted_distribution(counts: DataFrame) -> DataFrame:
    """``label_distribution`` from rows of ``ReportCounts.table``."""
    per_label = [F.struct(F.lit(name).alias("label"), F.col(f"label_{n}").alias("n")) for n, name in enumerate(ALL_LABELS)]
    known = sum((F.col(f"label_{n}") for n in range(len(ALL_LABELS))), F.lit(0))
    told = F.concat(F.col("labelled") - known, F.lit(" labels are not of the fixed set"))
    each = F.when(F.col("labelled") > known, F.raise_error(told)).otherwise(F.array(*per_label))
    counted = _added_up(counts).select(F.inline(each)).withColumnRenamed("n", "n_messages")
    return _with_percent(counted.where("n_messages > 0"))


def counted_coverage(counts: DataFrame) -> DataFrame:
    """``stage_coverage`` from rows of ``ReportCounts.table``."""
    return _with_shares(_added_up(counts).select(*_COVERAGE))


def reason_breakdown(labelled: DataFrame) -> DataFrame:
    """Labelled messages per deciding stage and reason."""
    return labelled.where(F.col("label").isNotNull()).groupBy("source", "reason").agg(
        F.count("*").alias("n_messages")
    )


def seed_collision_audit(messages: DataFrame) -> DataFrame:
    """What keying by ``seed_id`` would do: seeds shared by threads and rows that would be lost.

    Every grouping counts, so a seed or thread with many messages is combined before it is shuffled.
    """
    threads = messages.groupBy("seed_id", "thread_idx").agg(F.count("*").alias("__rows"))
    seeds = threads.groupBy("seed_id").agg(F.count("*").alias("__threads"))
    by_seed = seeds.agg(
        F.coalesce(F.sum("__threads"), F.lit(0)).alias("threads"),
        F.count("*").alias("distinct_seeds"),
        F.count_if(F.col("__threads") > 1).alias("shared_seeds"),
    )
    keys = messages.groupBy("seed_id", "turn_index").agg(F.count("*").alias("__rows"))
    by_key = keys.agg(
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("rows_lost_by_seed_key"),
        F.count_if(F.col("__rows") > 1).alias("colliding_keys"),
    )
    # Two single rows, laid over each other.
    both = by_seed.unionByName(by_key, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "reused", F.col("threads") - F.col("distinct_seeds")
    )
