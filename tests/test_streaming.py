"""Incremental jobs: equal to batch, and safe to stop, repeat and restart."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from convroute.config import Precedence, RoutingConfig
from convroute.operators import context, merge, rollup
from convroute.operators.requests import Reply
from convroute.operators.standin import fill_with_standin, offline_classifier
from convroute.plans import sample
from convroute.plans.run import local_stages
from convroute.sinks import keyed_log
from convroute.sources.result_log import read_log
from convroute.streaming import incremental

CONFIG = RoutingConfig()
COLUMNS = ("id", "label", "confidence", "source", "reason")


def rows(df, columns=COLUMNS):
    return sorted(map(str, df.select(*columns).collect()))


def uncommit(checkpoint, batch_id):
    """Make the engine believe that a micro-batch has not finished."""
    for name in (str(batch_id), f".{batch_id}.crc"):
        path = Path(checkpoint) / "commits" / name
        path.rename(path.with_name("lost-" + name.strip("."))) if path.exists() else None


@pytest.fixture(scope="module")
def open_messages(spark, sf_check):
    with_context = context.with_context(sample.messages(spark, sf_check), CONFIG)
    return merge.undecided(local_stages(with_context, CONFIG, scores=sample.scores(spark, sf_check)))


def test_routing_of_arriving_files(spark, sf_check, tmp_path):
    conv = sample.conversations(spark, sf_check)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    conv.where("conv_id < 40").write.parquet(source)

    def advance():
        stream = incremental.read_stream(spark, source, sample.CONVERSATION_SCHEMA)
        incremental.start_routing(
            sample.as_messages(stream), out, checkpoint, CONFIG, sample.scores(spark, sf_check)
        ).awaitTermination()
        return spark.read.parquet(out)

    def batch(where):
        messages = sample.as_messages(conv.where(where))
        return local_stages(messages, CONFIG, scores=sample.scores(spark, sf_check))

    assert rows(advance()) == rows(batch("conv_id < 40"))
    conv.where("conv_id >= 40").write.mode("append").parquet(source)
    assert rows(advance()) == rows(batch("true"))
    assert rows(advance()) == rows(batch("true"))


def test_model_stage_survives_failure_and_repeats(spark, open_messages, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    open_messages.repartition(3).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def start(classifier):
        stream = incremental.read_stream(spark, source, schema, max_files=1)
        return incremental.start_model_stage(stream, classifier, log, checkpoint, CONFIG)

    def no_model():
        raise OSError("model cannot be loaded")

    with pytest.raises(StreamingQueryException):
        start(no_model).awaitTermination()
    assert read_log(spark, log).count() == 0

    start(offline_classifier).awaitTermination()
    want = rows(fill_with_standin(open_messages))
    assert rows(read_log(spark, log)) == want

    uncommit(checkpoint, 2)
    start(offline_classifier).awaitTermination()
    assert rows(read_log(spark, log)) == want
    assert incremental.failed_messages(spark, f"{log}-state").count() == 0


def test_failed_calls_are_asked_again(spark, open_messages, tmp_path):
    """A classifier that is down, then recovers: after restarts every message is in the log or given up."""
    source, log, checkpoint, down = (str(tmp_path / n) for n in ("in", "log", "check", "down"))
    open_messages.coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    Path(down).touch()

    def flaky():
        answer = offline_classifier()

        def classify(prompt, texts):
            if Path(down).exists():
                raise RuntimeError("down")
            return answer(prompt, texts)

        return classify

    def start(config=CONFIG):
        stream = incremental.read_stream(spark, source, schema)
        incremental.start_model_stage(stream, flaky, log, checkpoint, config).awaitTermination()
        return rows(read_log(spark, log))

    assert start() == []
    # Nothing is asked while the budget is spent, and nothing is lost.
    assert start(replace(CONFIG, budget_usd="0")) == []
    Path(down).unlink()
    want = rows(fill_with_standin(open_messages))
    assert start() == want and start() == want
    costs = incremental.model_costs(spark, f"{log}-state").collect()
    assert sum(r.calls for r in costs) == 10 and sum(r.cost for r in costs) > 0


def test_a_message_is_given_up_in_plain_sight(spark, open_messages, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    open_messages.limit(7).coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def broken():
        return lambda prompt, texts: Reply("not json")

    for _ in range(CONFIG.attempts + 1):
        stream = incremental.read_stream(spark, source, schema)
        incremental.start_model_stage(stream, broken, log, checkpoint, CONFIG).awaitTermination()
    given_up = incremental.failed_messages(spark, f"{log}-state")
    assert given_up.count() == 7 and {r.error for r in given_up.collect()} == {"unreadable reply"}
    assert read_log(spark, log).count() == 0


def test_waiting_messages_are_written_once(spark, open_messages, tmp_path):
    """Fifty micro-batches while the budget is spent: each writes its own messages only, and none is lost."""
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    open_messages.repartition(50, "id").write.option("maxRecordsPerFile", 0).parquet(source)
    schema = spark.read.parquet(source).schema

    def start(config):
        stream = incremental.read_stream(spark, source, schema, max_files=1)
        incremental.start_model_stage(stream, offline_classifier, log, checkpoint, config).awaitTermination()

    spent = replace(CONFIG, budget_usd="0")
    start(spent)
    waiting = Path(f"{log}-state", "waiting")
    rounds = [spark.read.parquet(str(folder)).count() for folder in waiting.iterdir()]
    assert len(rounds) == len(list(Path(source).glob("*.parquet"))) > 40 and sum(rounds) == open_messages.count()
    before = sorted(waiting.rglob("*.parquet"))
    # Another start, and a micro-batch that is repeated, add nothing but that micro-batch.
    start(spent)
    assert sorted(waiting.rglob("*.parquet")) == before
    uncommit(checkpoint, len(rounds) - 1)
    start(spent)
    assert len(list(waiting.iterdir())) == len(rounds) + 1
    want = rows(fill_with_standin(open_messages))
    start(CONFIG)
    assert rows(read_log(spark, log)) == want
    start(CONFIG)
    assert rows(read_log(spark, log)) == want


def test_a_repeat_takes_no_answer_back(spark, open_messages, tmp_path):
    """A micro-batch that answered waiting messages too is repeated after a crash, with its slices merged."""
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    open_messages.repartition(4, "id").write.parquet(source)
    schema = spark.read.parquet(source).schema
    files = sorted(Path(source).glob("*.parquet"))
    held = [file.rename(tmp_path / file.name) for file in files[2:]]

    def start(config):
        stream = incremental.read_stream(spark, source, schema, max_files=1)
        incremental.start_model_stage(stream, offline_classifier, log, checkpoint, config).awaitTermination()

    config = replace(CONFIG, slices_to_merge=2, log_buckets=2)
    start(replace(config, budget_usd="0"))
    for file in held:
        file.rename(Path(source, file.name))
    # The start answers what waits; its rows and those of the micro-batches are merged as they gather.
    start(config)
    want = rows(fill_with_standin(open_messages))
    assert rows(keyed_log.read_compacted(spark, log)) == want
    last = max(int(p.name) for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit())
    uncommit(checkpoint, last)
    start(config)
    assert rows(keyed_log.read_compacted(spark, log)) == want
    assert keyed_log.log_parts(spark, log).runs
    keyed_log.vacuum(spark, log)
    uncommit(checkpoint, last)
    start(config)
    assert rows(keyed_log.read_compacted(spark, log)) == want


def test_routing_with_a_scorer(spark, sf_check, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    sample.conversations(spark, sf_check).write.parquet(source)
    stream = incremental.read_stream(spark, source, sample.CONVERSATION_SCHEMA)
    incremental.start_routing(
        sample.as_messages(stream), out, checkpoint, CONFIG, scorer=sample.length_scorer
    ).awaitTermination()
    batch = local_stages(sample.messages(spark, sf_check), CONFIG, scorer=sample.length_scorer)
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_thread_summary_without_state(spark, sf_check, tmp_path):
    labelled = fill_with_standin(
        local_stages(sample.messages(spark, sf_check), CONFIG, scores=sample.scores(spark, sf_check))
    )
    source, partials, checkpoint = (str(tmp_path / n) for n in ("in", "partials", "check"))
    # Threads are spread over files, so their parts arrive in different micro-batches.
    labelled.repartition(4, "turn_index").write.parquet(source)
    schema = spark.read.parquet(source).schema

    def advance():
        stream = incremental.read_stream(spark, source, schema, max_files=1)
        incremental.start_thread_summary(stream, partials, checkpoint).awaitTermination()
        summary = incremental.read_thread_summary(spark, partials)
        return rows(summary, summary.columns)

    batch = rollup.thread_summary(labelled)
    want = rows(batch, batch.columns)
    assert advance() == want
    uncommit(checkpoint, max(int(p.name) for p in (Path(checkpoint) / "commits").iterdir() if p.name.isdigit()))
    assert advance() == want

    # The same partials under the other precedence, before and after compaction.
    other = rollup.thread_summary(labelled, Precedence.LABEL_ORDER)
    for _ in range(2):
        summary = incremental.read_thread_summary(spark, partials, Precedence.LABEL_ORDER)
        assert rows(summary, summary.columns) == rows(other, other.columns)
        incremental.compact_partials(spark, partials)
        assert advance() == want
    assert len(list(Path(partials).glob("upto=*"))) == 1


def test_thread_summary_as_a_streaming_aggregate(spark, sf_small, tmp_path):
    labelled = fill_with_standin(local_stages(sample.messages(spark, sf_small), CONFIG))
    source = str(tmp_path / "in")
    labelled.write.parquet(source)
    stream = incremental.read_stream(spark, source, spark.read.parquet(source).schema)
    query = (
        rollup.thread_summary(stream).writeStream.format("memory").queryName("live_summary").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = rollup.thread_summary(labelled)
    assert rows(spark.table("live_summary"), batch.columns) == rows(batch, batch.columns)
