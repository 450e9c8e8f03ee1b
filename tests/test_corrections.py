"""Summaries of labels that are corrected later."""

import random
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from convroute.config import Precedence, RoutingConfig
from convroute.operators import rollup
from convroute.operators.standin import fill_with_standin
from convroute.plans import registry, sample
from convroute.plans.run import local_stages
from convroute.streaming import corrections, incremental
from convroute.streaming.folders import numbered_folders

CONFIG = RoutingConfig()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def uncommit(checkpoint):
    """Make the engine believe that the last micro-batch has not finished."""
    commits = Path(checkpoint) / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        path = commits / name
        path.rename(path.with_name("lost-" + name.strip("."))) if path.exists() else None


def test_a_later_pass_gives_the_batch_summary(spark, sf_small, tmp_path):
    staged = local_stages(sample.messages(spark, sf_small), CONFIG, scores=sample.scores(spark, sf_small))
    first = fill_with_standin(staged).where("thread_idx < 30").withColumn("pass_no", F.lit(1)).cache()
    source, deltas, checkpoint = (str(tmp_path / n) for n in ("in", "deltas", "check"))

    def advance():
        stream = incremental.read_stream(spark, source, first.schema)
        corrections.start_summary_with_corrections(stream, deltas, checkpoint, F.col("pass_no"), CONFIG).awaitTermination()
        return [rows(corrections.read_corrected_summary(spark, deltas, p)) for p in Precedence]

    def batch(labelled):
        return [rows(rollup.thread_summary(labelled, p)) for p in Precedence]

    first.coalesce(1).write.parquet(source)
    assert advance() == batch(first)
    low = F.col("confidence") == "low"
    changed = {"label": F.when(F.col("turn_index") % 3 > 0, F.lit("spam")), "confidence": F.lit("high"), "pass_no": F.lit(2)}
    second = first.where(low).withColumns(changed)
    second.coalesce(1).write.mode("append").parquet(source)
    want = batch(first.where(~low | low.isNull()).unionByName(second))
    assert want != batch(first)
    assert advance() == want
    # The last micro-batch again, the first pass once more (too old to count), and compaction change nothing.
    uncommit(checkpoint)
    assert advance() == want
    first.coalesce(1).write.mode("append").parquet(source)
    assert advance() == want
    corrections.compact_deltas(spark, deltas)
    assert advance() == want
    # A message may lose its label, and a thread all of them.
    none = first.where("thread_idx = 3").withColumns({"label": F.lit(None).cast("string"), "pass_no": F.lit(3)})
    none.coalesce(1).write.mode("append").parquet(source)
    assert [[r for r in found if "thread_idx=3)" not in r] for found in want] == advance()


def test_signed_changes():
    """Sums of changes equal the labels that count, whatever comes in which order."""
    rng = random.Random(4)
    known, total, counting = {}, Counter(), {}
    for _ in range(200):
        arrivals = [
            (rng.randrange(6), rng.randrange(3), rng.choice(["spam", "complaint", None]), rng.random() < 0.5)
            for _ in range(rng.randint(0, 4))
        ]
        total.update(corrections.apply_labels(known, arrivals))
        for turn in {a[0] for a in arrivals}:
            order, label, low = max((o, y or "", low) for t, o, y, low in arrivals if t == turn)
            if turn not in counting or counting[turn][0] <= order:
                counting[turn] = order, label, low
        want = Counter((label, low) for _, label, low in counting.values() if label)
        assert {k: n for k, n in total.items() if n} == want


def message(thread, turn, label, seed=1, platform="x", name="c", confidence="low"):
    return (thread, seed, platform, name, turn, "customer", label, confidence, 1)


SCHEMA = """thread_idx bigint, seed_id bigint, platform string, customer_name string, turn_index bigint, author string,
    label string, confidence string, pass_no int"""


def test_state_is_kept_by_block(spark, tmp_path, monkeypatch):
    """Many threads share a key of the state, and are not mixed up there."""
    monkeypatch.setattr(corrections, "BLOCKS", 8)
    big = 2**53 + 1
    odd = [
        message(1, 0, "spam"), message(1, 0, "complaint", platform=None), message(1, 0, "spam", platform="null"),
        message(None, 0, "spam"), message(None, 5000, "complaint", seed=None), message(big, 0, "spam"),
        message(big - 1, 0, "complaint"), message(2, 0, "spam", name='a "b"\\\n é'), message(2, 0, "spam", name=""),
    ]
    many = [message(t, turn, "complaint") for t in range(10, 110) for turn in (0, 1, 4096)]
    first = spark.createDataFrame(odd + many, SCHEMA)
    second = first.withColumns({"label": F.lit("spam"), "confidence": F.lit("high"), "pass_no": F.lit(2)})
    second = second.where("turn_index <> 1")
    source, deltas, checkpoint = (str(tmp_path / n) for n in ("in", "deltas", "check"))
    want = first, second.unionByName(first.where("turn_index = 1"))
    for arriving, labelled in zip((first, second), want, strict=True):
        arriving.coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_stream(spark, source, first.schema)
        query = corrections.start_summary_with_corrections(stream, deltas, checkpoint, F.col("pass_no"), CONFIG)
        query.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 8
        assert rows(corrections.read_corrected_summary(spark, deltas)) == rows(rollup.thread_summary(labelled))


def test_micro_batches_do_not_grow_with_files(spark, sf_small, tmp_path, monkeypatch):
    conversations = sample.conversations(spark, sf_small)
    conversations.repartition(20).write.parquet(str(tmp_path / "conversations.parquet"))
    folders = []
    read = corrections.read_corrected_summary
    monkeypatch.setattr(corrections, "read_corrected_summary", lambda s, path: folders.append(path) or read(s, path))
    # One file a task, so that as many are written.
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    try:
        for key in keys:
            spark.conf.set(key, "1m")
        got = rows(registry.incremental_corrections(spark, str(tmp_path)))
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)
    staged = local_stages(sample.messages(spark, sf_small), CONFIG, scores=sample.scores(spark, sf_small))
    low = F.col("confidence") == "low"
    label = F.when(low, "complaint").otherwise(F.col("label"))
    confidence = F.when(low, "high").otherwise(F.col("confidence"))
    corrected = fill_with_standin(staged).withColumns({"label": label, "confidence": confidence})
    assert got == rows(rollup.thread_summary(corrected))
    batches = len(numbered_folders(spark, folders[0], "batch"))
    assert 2 < batches <= 2 * registry.MICRO_BATCHES
