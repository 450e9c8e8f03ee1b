"""Whole runs: labels, refinement, resuming, budget and slices."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.operators import context, merge, rollup, stages
from convroute.operators.standin import fill_with_standin, offline_classifier
from convroute.plans import sample
from convroute.plans.run import local_stages, run_routing
from convroute.sinks import tables
from convroute.sources.result_log import read_log

CONFIG = RoutingConfig()


def counting(path, fail_size=None):
    """The stand-in, noting every text it is asked about."""

    def factory():
        answer = offline_classifier()

        def classify(prompt, texts):
            with open(path, "a", encoding="utf-8") as f:
                f.write(f"{len(texts)}\n")
            if len(texts) == fail_size:
                raise RuntimeError("refused")
            return answer(prompt, texts)

        return classify

    return factory


def asked(path):
    try:
        with open(path, encoding="utf-8") as f:
            return [int(line) for line in f]
    except FileNotFoundError:
        return []


@pytest.fixture(scope="module")
def inputs(spark, sf_check):
    messages = context.with_context(sample.messages(spark, sf_check), CONFIG)
    scores = sample.scores(spark, sf_check)
    expected = fill_with_standin(local_stages(sample.messages(spark, sf_check), CONFIG, scores=scores))
    return messages, scores, sorted(map(tuple, merge.labels_output(expected).collect()))


def output(run):
    return sorted(map(tuple, run.labels.collect()))


def test_run_equals_stages_in_place(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    calls = str(tmp_path / "calls")
    run = run_routing(messages, counting(calls), str(tmp_path / "log"), CONFIG, scores=scores)
    assert output(run) == expected
    assert sorted(asked(calls)) == [21, 25, 25, 25, 25]
    meter = run.cost_meter.first()
    assert (meter["model"], meter["calls"], meter["out_tok"]) == ("gemini-3.5-flash-lite", 5, 1210)
    coverage = run.stage_coverage.first()
    assert (coverage["to_model"], coverage["model_decided"], coverage["low_confidence"]) == (121, 121, 126)
    assert {r["label"]: r["n_messages"] for r in run.label_distribution.collect()}["brand_message"] == 233
    assert run.thread_summary.count() == 100

    tables.write_outputs(run.labels, run.thread_summary, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "labels")).count() == 536
    assert spark.read.parquet(str(tmp_path / "out" / "thread_summary")).count() == 100

    # The same run again asks nothing and says the same.
    again = run_routing(messages, counting(calls), str(tmp_path / "log"), CONFIG, scores=scores)
    assert output(again) == expected and len(asked(calls)) == 5
    # Another batch size is another question.
    other = replace(CONFIG, batch_size=50)
    run_routing(messages, counting(calls), str(tmp_path / "log"), other, scores=scores)
    assert sorted(asked(calls)[5:]) == [21, 50, 50]
    assert run.unfinished.count() == 0
    run.workspace.drop()


def test_slices_and_budget_stop_then_resume(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    poor = replace(CONFIG, budget_usd="0.003")
    poor = replace(poor, first_slice=1)
    stopped = run_routing(messages, counting(calls), log, poor, scores=scores)
    done = sum(asked(calls))
    assert 0 < done < 121 and stopped.labelled.where("source = 'api'").count() == done
    blanks = [r for r in output(stopped) if r[5] == "customer" and r[7] == ""]
    assert len(blanks) == 121 - done and all(r[7:] == ("", "", "", "") for r in blanks)
    left = stopped.unfinished.collect()
    assert sum(r.n_messages for r in left) == 121 - done and all(r.error is None for r in left)
    resumed = run_routing(messages, counting(calls), log, replace(CONFIG, first_slice=2), scores=scores)
    assert output(resumed) == expected and sum(asked(calls)) == 121


def test_failed_batches_stay_blank_and_are_asked_again(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    run = run_routing(messages, counting(calls, fail_size=21), log, CONFIG, scores=scores)
    missing = run.labelled.where("author = 'customer' and label is null").count()
    assert missing == 21
    assert [(r.pass_no, r.n_messages, r.error) for r in run.unfinished.collect()] == [(0, 21, "refused")]
    later = run_routing(messages, counting(calls), log, CONFIG, scores=scores)
    assert output(later) == expected
    assert sum(asked(calls)) == 121 + missing


def test_refine_changes_only_low_confidence_rows(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    run = run_routing(messages, offline_classifier, str(tmp_path / "log"), CONFIG, scores=scores, refine=True)
    before = {r[0]: r for r in expected}
    sources = Counter()
    for r in output(run):
        if before[r[0]][8] == "low":
            assert r[9:] == ("api_refine", "api_classified")
        else:
            assert r == before[r[0]]
        sources[r[9]] += 1
    assert sources["api_refine"] == 126 and sources["api"] == 0
    assert {r["model"] for r in run.cost_meter.collect()} == {"gemini-3.5-flash-lite", "gemini-3.5-flash"}


def test_dear_calls_stop_at_the_budget(spark, inputs, tmp_path):
    """Real costs twelve times the estimate: spending passes the budget by one slice at most."""
    messages, scores, _ = inputs

    def dear():
        answer = offline_classifier()

        def classify(prompt, texts):
            r = answer(prompt, texts)
            return replace(r, prompt_tokens=r.prompt_tokens + 1300, thinking_tokens=2000)

        return classify

    config = replace(CONFIG, batch_size=5, budget_usd="0.030", first_slice=2)
    run = run_routing(messages, dear, str(tmp_path / "log"), config, scores=scores)
    meter = run.cost_meter.first()
    assert 0.030 <= meter["cost"] < 0.030 + 1.5 * meter["cost"] / meter["calls"]
    assert run.unfinished.count() == 25 - meter["calls"] > 0


def test_a_changed_message_is_asked_again(spark, inputs, tmp_path):
    messages, scores, _ = inputs
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    run_routing(messages, counting(calls), log, CONFIG, scores=scores)
    one = merge.undecided(local_stages(messages, CONFIG, scores=scores)).orderBy("id").first()
    same = (F.col("thread_idx") == one["thread_idx"]) & (F.col("turn_index") == one["turn_index"])
    # The new text stays undecided by the local stages, and the stand-in calls it a complaint.
    changed = messages.withColumn("text", F.when(same, "ok noted disappointed not").otherwise(F.col("text")))
    again = run_routing(changed, counting(calls), log, CONFIG)
    fresh = run_routing(changed, offline_classifier, str(tmp_path / "other"), CONFIG)
    assert output(again) == output(fresh)


def test_threads_that_moved_keep_no_foreign_labels(spark, inputs, tmp_path):
    messages, _, _ = inputs
    log = str(tmp_path / "log")
    run_routing(messages, offline_classifier, log, CONFIG)
    moved = messages.withColumn("thread_idx", (F.col("thread_idx") + 1) % 100).withColumn(
        "id", F.concat_ws(":", "thread_idx", "turn_index")
    )
    again = run_routing(moved, offline_classifier, log, CONFIG)
    assert output(again) == output(run_routing(moved, offline_classifier, str(tmp_path / "other"), CONFIG))


def test_a_stage_added_later_wins_over_the_log(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    log = str(tmp_path / "log")
    run_routing(messages, offline_classifier, log, CONFIG)
    assert output(run_routing(messages, offline_classifier, log, CONFIG, scores=scores)) == expected


def test_one_model_for_both_passes(spark, inputs, tmp_path):
    messages, scores, _ = inputs
    config = replace(CONFIG, refine_model=CONFIG.first_pass_model)
    run = run_routing(messages, offline_classifier, str(tmp_path / "log"), config, scores=scores, refine=True)
    assert run.labelled.where("source = 'api_refine'").count() == 126


def test_without_sentiment_and_with_a_scorer(spark, inputs, tmp_path, sf_check):
    messages, _, _ = inputs
    plain = run_routing(messages, offline_classifier, str(tmp_path / "a"), CONFIG)
    assert plain.stage_coverage.first()["to_model"] == 145
    scored = run_routing(messages, offline_classifier, str(tmp_path / "b"), CONFIG, scorer=sample.length_scorer)
    table = stages.score_texts(stages.route(sample.messages(spark, sf_check)), sample.length_scorer)
    by_table = local_stages(
        sample.messages(spark, sf_check), CONFIG, scores=table.where(F.col("sentiment").isNotNull())
    )
    assert output(scored) == sorted(map(tuple, merge.labels_output(fill_with_standin(by_table)).collect()))


def test_empty_corpus(spark, inputs, tmp_path):
    messages, _, _ = inputs
    run = run_routing(messages.where("thread_idx < 0"), offline_classifier, str(tmp_path / "log"), CONFIG)
    assert run.labels.count() == 0 and run.thread_summary.count() == 0
    assert run.stage_coverage.first()["router_percent"] == 0


def test_log_is_partitioned_by_fingerprint(spark, inputs, tmp_path):
    messages, scores, _ = inputs
    log = str(tmp_path / "log")
    run_routing(messages, offline_classifier, log, CONFIG, scores=scores)
    rows = read_log(spark, log)
    assert rows.select("fingerprint").distinct().count() == 1
    assert rows.count() == rows.select("id").distinct().count() == 121
    assert "fingerprint" in rows.where("fingerprint = 'x'")._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters"
    )[1]


def test_summary_matches_plain_python(spark, inputs):
    messages, scores, expected = inputs
    order = ("urgent_escalation", "spam", "refund_request", "order_inquiry", "complaint", "compliment")
    by_thread = {}
    for r in expected:
        if r[5] == "customer" and r[7] in order:
            by_thread.setdefault(r[1], []).append((r[7], r[8]))
    labelled = fill_with_standin(local_stages(messages, CONFIG, scores=scores))
    for r in rollup.thread_summary(labelled).collect():
        seen = by_thread.pop(r["thread_idx"])
        names = sorted({label for label, _ in seen}, key=order.index)
        assert (r["n_customer_messages"], r["primary_label"], r["all_labels_seen"]) == (len(seen), names[0], ", ".join(names))
        assert r["has_low_confidence_turn"] == ("yes" if any(c == "low" for _, c in seen) else "")
    assert not by_thread


def test_limit_keeps_whole_threads(spark, inputs, tmp_path):
    messages, scores, expected = inputs
    run = run_routing(messages, offline_classifier, str(tmp_path / "log"), CONFIG, scores=scores, limit=10)
    assert output(run) == [r for r in expected if r[1] < 10]


def test_null_text_is_empty_but_reads_none_as_context(spark):
    rows = [(0, 0, "customer", None), (0, 1, "customer", "hi"), (0, 2, "brand", None)]
    flat = spark.createDataFrame(rows, "thread_idx long, turn_index long, author string, text string")
    staged = local_stages(context.with_context(flat, CONFIG), CONFIG).orderBy("turn_index").collect()
    assert [r["text"] for r in staged] == ["", "hi", ""]
    assert [r["router_reason"] for r in staged] == ["empty_message", "no_confident_signal", None]
    assert staged[2]["context"] == ["customer: None", "customer: hi"]
