"""Reports counted in the pass that writes the labels."""

import uuid

import pytest
from pyspark.sql import functions as F

from convroute.config import BRAND_LABEL, LABELS
from convroute.operators import audits
from convroute.plans import registry, sample
from convroute.sinks.tables import in_corpus_order
from convroute.streaming import incremental

SCHEMA = "thread_idx bigint, turn_index int, author string, label string, confidence string, source string"
ROWS = [
    (1, 0, "customer", LABELS[0], "high", "router"),
    (1, 1, "brand", BRAND_LABEL, "n/a", "rule"),
    (1, 2, "customer", LABELS[2], "low", "api"),
    (2, 0, "customer", None, None, None),
    (2, 1, None, None, None, None),
    (2, 2, "customer", LABELS[2], "low", "api_refine"),
    (None, None, "customer", LABELS[1], "low", "sentiment"),
]


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def jobs_of(spark, action):
    """Jobs that an action starts."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(found)


@pytest.mark.parametrize("n", [len(ROWS), 1, 0])
@pytest.mark.parametrize("ordered", [False, True])
def test_counts_equal_a_second_reading(spark, tmp_path, n, ordered):
    labelled = spark.createDataFrame(ROWS[:n], SCHEMA).repartition(3)
    counts = audits.ReportCounts()
    # Counted above the sort: below, the sample that fixes its ranges would count, too.
    counts.observe(in_corpus_order(labelled) if ordered else labelled).write.parquet(str(tmp_path / "labels"))
    stored = spark.read.schema(SCHEMA).parquet(str(tmp_path / "labels"))
    assert rows(counts.label_distribution(spark)) == rows(audits.label_distribution(stored))
    assert rows(counts.stage_coverage(spark)) == rows(audits.stage_coverage(stored))


def test_the_write_is_the_only_pass(spark, tmp_path):
    labelled = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    plain = jobs_of(spark, lambda: labelled.write.parquet(str(tmp_path / "plain")))
    counts = audits.ReportCounts()
    assert jobs_of(spark, lambda: counts.observe(labelled).write.parquet(str(tmp_path / "counted"))) == plain
    # The rest is one row of the driver: nothing reads the labels again.
    for report in (counts.label_distribution(spark), counts.stage_coverage(spark)):
        assert report.inputFiles() == [] and "Scan parquet" not in report._jdf.queryExecution().toString()


def test_a_label_outside_the_set_is_told(spark, tmp_path):
    labelled = spark.createDataFrame([(1, 0, "customer", "of my own", "high", "api")], SCHEMA)
    counts = audits.ReportCounts()
    counts.observe(labelled).write.parquet(str(tmp_path / "labels"))
    assert counts.stage_coverage(spark).first()["labelled"] == 1
    with pytest.raises(Exception, match="1 labels are not of the fixed set"):
        counts.label_distribution(spark).collect()


def test_a_micro_batch_leaves_its_counts_and_a_repeat_replaces_them(spark, sf_small, tmp_path):
    stored, out = str(tmp_path / "messages"), str(tmp_path / "out")
    messages = sample.messages(spark, sf_small)
    messages.repartition(4, F.xxhash64("id")).write.parquet(stored)

    def advance(checkpoint):
        arriving = incremental.read_stream(spark, stored, messages.schema, max_files=1)
        incremental.start_reported_routing(
            arriving, out, str(tmp_path / checkpoint), registry.CONFIG, sample.scores(spark, sf_small)
        ).awaitTermination()
        return incremental.read_report_counts(spark, out)

    assert rows(audits.counted_coverage(incremental.read_report_counts(spark, out)))[0].count("=0") >= 8
    want_coverage = rows(audits.stage_coverage(registry._staged(spark, sf_small)))
    want_labels = rows(audits.label_distribution(registry._staged(spark, sf_small)))
    for checkpoint in ("one", "one", "after-a-loss-of-the-checkpoint"):
        counts = advance(checkpoint)
        assert counts.count() == 4
        assert rows(audits.counted_coverage(counts)) == want_coverage
        assert rows(audits.counted_distribution(counts)) == want_labels
