"""Context, numbering, requests, replies, merging, budget and audits on small fixtures."""

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from convroute.config import LABELS, RoutingConfig
from convroute.operators import audits, context, merge, numbering, requests, responses, rollup
from convroute.operators.standin import offline_classifier
from convroute.plans import sample
from convroute.workspace import Workspace

CONFIG = RoutingConfig()


def hot_messages(spark, hot=500, others=60):
    """One thread holds most messages."""
    rng = random.Random(1)
    rows = [(7, t) for t in range(hot)] + [(i, t) for i in range(8, 8 + others) for t in range(rng.randint(1, 4))]
    rng.shuffle(rows)
    data = [
        (f"{i}:{t}", i, i % 5, t, "x", ("customer", "brand", "system")[(i + t) % 3], None if t % 9 == 4 else f"m{i}.{t}", "n")
        for i, t in rows
    ]
    return spark.createDataFrame(
        data,
        "id string, thread_idx long, seed_id long, turn_index long, platform string, author string, text string,"
        " customer_name string",
    )


@pytest.mark.parametrize("chunk", (2, 3, 64, 4096))
def test_context_is_the_same_however_threads_are_split(spark, chunk):
    df = hot_messages(spark)
    config = RoutingConfig(chunk_turns=chunk)
    by_key = {(r["thread_idx"], r["turn_index"]): r for r in df.collect()}
    got = context.with_context(df, config).collect()
    assert len(got) == len(by_key)
    for r in got:
        prior = [by_key[(r["thread_idx"], t)] for t in range(max(0, r["turn_index"] - 2), r["turn_index"])]
        assert r["context"] == [f"{p['author']}: {p['text']}" for p in prior]


def test_context_block(spark):
    df = spark.createDataFrame([([],), (["a: b"],), (["a: b", "c: d"],)], "c array<string>")
    got = [r[0] for r in df.select(context.context_block(F.col("c"))).collect()]
    assert got == ["(first message in thread)", "a: b", "a: b | c: d"]


@pytest.mark.parametrize("size", (1, 7, 25))
def test_batches_equal_a_global_sort(spark, size):
    df = hot_messages(spark).repartition(13)
    batched = numbering.assign_batches(df, size, Workspace(spark, "t")).collect()
    order = sorted((r["thread_idx"], r["turn_index"]) for r in df.collect())
    want = {key: (n // size, n % size) for n, key in enumerate(order)}
    assert {(r["thread_idx"], r["turn_index"]): (r["batch"], r["local_i"]) for r in batched} == want


def test_batches_do_not_change_when_read_twice(spark):
    batched = numbering.assign_batches(hot_messages(spark), 25, Workspace(spark, "t"))
    assert sorted(batched.collect(), key=str) == sorted(batched.repartition(5).collect(), key=str)


def test_batches_of_nothing(spark):
    empty = hot_messages(spark).where("thread_idx < 0")
    assert numbering.assign_batches(empty, 25, Workspace(spark, "t")).count() == 0


def test_prompt_layout(spark):
    rows = [
        Row(id="0:0", thread_idx=0, seed_id=0, turn_index=0, platform="x", author="customer", text="  a\nb ", context=[], batch=0, local_i=0),
        Row(id="0:1", thread_idx=0, seed_id=0, turn_index=1, platform="x", author="customer", text=" \n ", context=["customer: a"], batch=0, local_i=1),
        Row(id="0:2", thread_idx=0, seed_id=0, turn_index=2, platform="x", author="customer", text="é" * 1300, context=["c: " + "y" * 2000], batch=0, local_i=2),
    ]
    df = spark.createDataFrame(rows).withColumn("local_i", F.col("local_i").cast("int"))
    got = requests.build_requests(df, CONFIG).first()
    assert got["prompt"] == (
        "Classify these 3 messages:\n\n"
        "[0] context: (first message in thread)\n    message: a b\n"
        "[1] context: customer: a\n    message: (empty message)\n"
        f"[2] context: c: {'y' * 2000}\n    message: {'é' * 1200}"
    )
    assert got["texts"] == ["  a\nb ", " \n ", "é" * 1300]
    assert [m["id"] for m in got["members"]] == ["0:0", "0:1", "0:2"]
    tokens = requests.estimate_tokens(requests.build_requests(df, CONFIG)).first()
    assert (tokens["prompt_tokens"], tokens["output_tokens"]) == (len(got["prompt"]) // 4, 30)


M = ("order_inquiry", "low", True)
BODIES = (
    (
        '[{"i":0,"label":"spam","conf":"high"},{"i":1,"label":"urgent_escalation","conf":"high"},'
        '{"i":2,"label":"complaint","conf":"low"}]',
        [("spam", "high", False), ("urgent_escalation", "high", False), ("complaint", "low", False)],
    ),
    ('[{"i":"1","label":"complaint"},{"x":3}]', [M, ("complaint", "low", False), M]),
    ('[{"i":0,"label":"spam","conf":"high"},{"i":0,"label":"bogus","conf":"high"}]', [M, M, M]),
    ('[{"i":2.7,"label":"spam","conf":"maybe"}]', [M, M, ("spam", "maybe", False)]),
    ('{"i":0,"label":"spam","conf":"high"}', [M, M, M]),
    ("not json", None),
    (None, None),
    ("", None),
    ("5", [M, M, M]),
    ("null", [M, M, M]),
    ("[]", [M, M, M]),
    ('[5, "x", null, [1], {"i":1,"label":"spam","conf":"high"}]', [M, ("spam", "high", False), M]),
    ('[{"i":"2.7","label":"spam"}]', [M, M, M]),
    ('[{"i":" +2 ","label":"spam"},{"i":"1_0","label":"spam"}]', [M, M, ("spam", "low", False)]),
    ('[{"i":true,"label":"spam"},{"i":null,"label":"spam"},{"i":[0],"label":"spam"}]', [M, ("spam", "low", False), M]),
    ('[{"i":1e0,"label":"refund_request","conf":null}]', [M, ("refund_request", None, False), M]),
    ('[{"i":-0.5,"label":"compliment","conf":"high"}]', [("compliment", "high", False), M, M]),
    ('[{"i":"٢","label":"compliment","conf":"high"}]', [M, M, ("compliment", "high", False)]),
    ('[{"i":0,"label":["spam"],"conf":"high"},{"i":1,"label":7}]', [M, M, M]),
    ('[{"i":99999999999999999999,"label":"spam"}]', [M, M, M]),
)


def replies(spark):
    members = [Row(id=f"0:{i}", thread_idx=0, seed_id=0, turn_index=i, platform="", author="customer") for i in range(3)]
    rows = [(n, 3, members, body) for n, (body, _) in enumerate(BODIES)]
    schema = (
        "batch long, n_messages int, members array<struct<id:string,thread_idx:long,seed_id:long,turn_index:long,"
        "platform:string,author:string>>, body string"
    )
    return responses.parse_replies(spark.createDataFrame(rows, schema))


def test_reply_repair(spark):
    got = {}
    for r in responses.merge_replies(replies(spark)).collect():
        got[(r["batch"], r["turn_index"])] = (r["label"], r["confidence"], r["missing"])
        assert r["reason"] == ("api_missing_index" if r["missing"] else "api_classified")
    want = {(n, i): out for n, (_, outs) in enumerate(BODIES) for i, out in enumerate(outs or ())}
    assert got == want


def test_reply_quality(spark):
    q = responses.reply_quality(replies(spark)).first()
    assert (q["batches"], q["failed_batches"], q["not_a_list"]) == (20, 3, 3)
    assert q["messages"] == 60


def test_classifier_failure_leaves_its_batch_unlabelled(spark):
    def flaky():
        answer = offline_classifier()

        def classify(prompt, texts):
            if "fail" in texts[0]:
                raise RuntimeError("no answer")
            return answer(prompt, texts)

        return classify

    member = Row(id="0:0", thread_idx=0, seed_id=0, turn_index=0, platform="", author="customer")
    df = spark.createDataFrame(
        [(0, 1, "p" * 40, ["refund"], [member]), (1, 1, "p", ["fail"], [member])],
        "batch long, n_messages int, prompt string, texts array<string>, members array<struct<id:string,"
        "thread_idx:long,seed_id:long,turn_index:long,platform:string,author:string>>",
    )
    called = requests.classify_requests(df, flaky, 2)
    by_batch = {r["batch"]: r for r in called.collect()}
    assert by_batch[1]["body"] is None and by_batch[1]["error"] == "no answer"
    assert (by_batch[0]["prompt_tokens"], by_batch[0]["output_tokens"], by_batch[0]["error"]) == (10, 10, None)
    rows = responses.merge_replies(responses.parse_replies(called)).collect()
    assert [(r["batch"], r["label"]) for r in rows] == [(0, "refund_request")]


def test_cost_and_default_price(spark):
    df = spark.createDataFrame(
        [(0, "gemini-3.5-flash-lite", 1000, 250, 50), (1, "gemini-3.5-flash", 1000, 250, 0), (2, "other", 1_000_000, 1_000_000, 0)],
        "batch long, model string, prompt_tokens long, output_tokens long, thinking_tokens long",
    )
    got = {r["model"]: r for r in requests.cost_meter(df, CONFIG).collect()}
    assert got["gemini-3.5-flash-lite"]["cost"] == pytest.approx(1000 / 1e6 * 0.30 + 300 / 1e6 * 2.50, abs=1e-15)
    assert got["gemini-3.5-flash-lite"]["out_tok"] == 300
    assert got["gemini-3.5-flash"]["cost"] == pytest.approx(1000 / 1e6 * 0.75 + 250 / 1e6 * 4.50, abs=1e-15)
    assert got["other"]["cost"] == pytest.approx(0.5)


@pytest.mark.parametrize("block", (1, 3, 65536))
@pytest.mark.parametrize("spent", ("0", "0.0031"))
def test_budget_plan(spark, block, spent):
    rng = random.Random(2)
    rows = [(b, "gemini-3.5-flash-lite", rng.randint(500, 3000), 250, 0) for b in range(40)]
    df = spark.createDataFrame(
        rows, "batch long, model string, prompt_tokens long, output_tokens long, thinking_tokens long"
    ).repartition(4)
    config = RoutingConfig(budget_usd="0.02")
    got = {r["batch"]: r for r in requests.budget_plan(df, config, spent, block).collect()}
    before = Decimal(spent)
    for b, _, tin, tout, _ in rows:
        assert got[b]["spent_before"] == before
        assert got[b]["runs"] == (before < Decimal("0.02"))
        before += (Decimal(tin) * Decimal("0.30") + Decimal(tout) * Decimal("2.50")) / 1_000_000
    assert {True, False} == {r["runs"] for r in got.values()}


def labelled(spark):
    schema = "thread_idx long, seed_id long, platform string, customer_name string, turn_index long, author string, label string, confidence string"
    rows = [
        (0, 5, "x", "a", 0, "customer", "compliment", "high"),
        (0, 5, "x", "a", 1, "customer", "urgent_escalation", "high"),
        (0, 5, "x", "a", 2, "customer", "complaint", "low"),
        (0, 5, "x", "a", 3, "customer", "complaint", None),
        (0, 5, "x", "a", 4, "brand", "brand_message", "n/a"),
        (1, 5, "", "b", 0, "customer", "order_inquiry", "high"),
        (1, 5, "", "b", 1, "customer", None, None),
        (2, 6, "x", "c", 0, "customer", None, None),
        (3, 7, "x", "d", 0, "brand", "brand_message", "n/a"),
        (4, 5, None, "e", 0, "customer", "spam", "maybe"),
    ]
    return spark.createDataFrame(rows, schema)


def test_thread_summary_orders(spark):
    from convroute.config import Precedence

    rows = [tuple(r) for r in rollup.thread_summary(labelled(spark), Precedence.DOCUMENTED).orderBy("thread_idx").collect()]
    assert rows == [
        (0, 5, "x", "a", 4, "urgent_escalation", "urgent_escalation, complaint, compliment", "yes"),
        (1, 5, "", "b", 1, "order_inquiry", "order_inquiry", ""),
        (4, 5, None, "e", 1, "spam", "spam", ""),
    ]
    rows = [tuple(r) for r in rollup.thread_summary(labelled(spark), Precedence.LABEL_ORDER).orderBy("thread_idx").collect()]
    assert rows[0][5:7] == ("complaint", "complaint, compliment, urgent_escalation")


def test_partial_summaries_merge(spark):
    df = labelled(spark)
    whole = rollup.thread_summary(df)
    parts = rollup.partial_summary(df.where("turn_index % 2 = 0")).unionByName(
        rollup.partial_summary(df.where("turn_index % 2 = 1"))
    )
    merged = rollup.finish_summary(rollup.merge_partials(parts))
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_seed_audit(spark):
    r = audits.seed_collision_audit(labelled(spark)).first()
    assert (r["threads"], r["distinct_seeds"], r["shared_seeds"], r["reused"]) == (5, 3, 1, 2)
    assert (r["rows_lost_by_seed_key"], r["colliding_keys"]) == (3, 2)


def test_last_wins(spark):
    base = spark.createDataFrame(
        [("0:0", 0, 0, "a"), ("0:1", 0, 1, "b"), ("1:0", 1, 0, "c")], "id string, thread_idx long, turn_index long, label string"
    )
    again = spark.createDataFrame([("0:1", 0, 1, "z")], base.schema)
    rows = merge.last_wins(merge.union_results(base, again)).collect()
    assert sorted((r["id"], r["label"]) for r in rows) == [("0:0", "a"), ("0:1", "z"), ("1:0", "c")]


def test_scorer_sees_only_open_texts(spark, sf_small):
    from convroute.operators import stages

    def factory():
        def score(texts):
            assert all(t.strip() for t in texts)
            return [("Positive" if t == "." else "neg", 0.5) for t in texts]

        return score

    scored = stages.score_texts(stages.route(sample.messages(spark, sf_small), CONFIG), factory)
    rows = scored.select("author", "label", "text", "sentiment", "score").collect()
    for r in rows:
        if r["author"] == "customer" and r["label"] is None:
            assert r["sentiment"] == ("positive" if not r["text"].strip() else "negative") and r["score"] == 0.5
        else:
            assert r["sentiment"] is None and r["score"] is None


def test_gaps_and_repeats_in_turns_fail(spark):
    schema = "thread_idx long, turn_index long, author string, text string"
    for turns in ((0, 2), (1, 2), (0, 1, 1), (0, 1, 2, 3, 5)):
        df = spark.createDataFrame([(4, t, "customer", "x") for t in turns], schema)
        with pytest.raises(Exception, match="no turn just before 4:"):
            context.with_context(df, replace(CONFIG, chunk_turns=2)).collect()
    with pytest.raises(ValueError, match="chunk_turns"):
        context.with_context(df, replace(CONFIG, chunk_turns=1))


def test_reply_schema_names_the_labels():
    assert responses.REPLY_SCHEMA["items"]["properties"]["label"]["enum"] == list(LABELS)


def test_prices_may_hold_any_name(spark):
    config = replace(CONFIG, prices=(("it's a \"model\"", "2", "4"),))
    df = spark.createDataFrame(
        [(0, "it's a \"model\"", 1_000_000, 0, 0)],
        "batch long, model string, prompt_tokens long, output_tokens long, thinking_tokens long",
    )
    assert requests.cost_meter(df, config).first()["cost"] == 2.0


def test_tasks_grow_with_calls(spark):
    assert [requests.call_tasks(n) for n in (0, 1, 100, 101, 100_000)] == [1, 1, 1, 2, 1000]
    df = spark.range(1000).selectExpr(
        "id AS batch", "1 AS n_messages", "'p' AS prompt", "array('t') AS texts", "array() AS members"
    )
    called = requests.classify_requests(df, offline_classifier, requests.call_tasks(1000))
    sizes = called.groupBy(F.spark_partition_id()).count().collect()
    assert "prompt" not in called.columns and len(sizes) == 10 and max(r["count"] for r in sizes) < 300
