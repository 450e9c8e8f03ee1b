"""Golden phrases: signals and both rule cascades; golden counts at three scale factors."""

from pathlib import Path

import golden
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.config import Precedence, RoutingConfig
from convroute.operators import merge, rollup, stages
from convroute.operators.standin import fill_with_standin
from convroute.plans import sample
from convroute.plans.run import local_stages

CONFIG = RoutingConfig()
SENTIMENTS = (("negative", 0.9), ("positive", 0.9), ("neutral", 0.9), ("negative", 0.5))


def as_customer(spark, texts):
    rows = [(f"{i}:0", i, 0, "customer", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id string, thread_idx long, turn_index long, author string, text string")


@pytest.fixture(scope="module")
def routed(spark):
    return stages.route(as_customer(spark, [p[0] for p in golden.PHRASES]), CONFIG)


def test_signals(routed):
    rows = {r["thread_idx"]: r for r in routed.collect()}
    for i, (text, names, *_) in enumerate(golden.PHRASES):
        want = {golden.SIGNAL_NAMES[n] for n in names.split()}
        got = {s for s in lx.SIGNALS if rows[i][s]}
        assert got == want, (text, got, want)


def test_stage_1(routed):
    rows = {r["thread_idx"]: r for r in routed.collect()}
    for i, (text, _, label, confidence, reason, _) in enumerate(golden.PHRASES):
        r = rows[i]
        assert (r["label"], r["router_reason"]) == (label, reason), text
        if label:
            assert (r["confidence"], r["source"], r["reason"]) == (confidence, "router", reason)
        else:
            assert r["confidence"] is None and r["source"] is None


def test_all_outcomes_are_covered():
    assert len({p[4] for p in golden.PHRASES}) == 13


@pytest.mark.parametrize("k", range(4))
def test_stage_2(routed, k):
    sentiment, score = SENTIMENTS[k]
    scored = routed.withColumn("sentiment", F.lit(sentiment)).withColumn("score", F.lit(score))
    rows = {r["thread_idx"]: r for r in stages.apply_sentiment(scored, CONFIG).collect()}
    for i, (text, _, label, _, _, outcomes) in enumerate(golden.PHRASES):
        if label:
            assert rows[i]["label"] == label and rows[i]["sentiment_reason"] is None
            continue
        want_label, want_reason = golden.STAGE_2[outcomes.split()[k]]
        r = rows[i]
        assert (r["label"], r["sentiment_reason"]) == (want_label, want_reason), (text, sentiment, score)
        if want_label:
            assert (r["confidence"], r["source"], r["reason"]) == ("high", "sentiment", want_reason)


UNICODE_ROWS = (
    ("#١٢٣", {"has_tracking"}),
    ("é123 order", set()),
    ("123 orders", set()),
    ("x #123", {"has_tracking"}),
    ("İstanbul THANKS", {"has_positive_keyword"}),
    ("great, no thanks", {"is_declining"}),
    ("no " + "x" * 18 + "thanks", {"has_positive_keyword"}),
    ("no " + "x" * 17 + "thanks", set()),
    ("HTTPS://A.B", {"has_bare_url"}),
    ("WWW.a", {"has_bare_url"}),
    ("httpſ://a", {"has_bare_url"}),
    ("لأ شكرا", {"is_declining"}),
    ("a.b+c@d-e.f", {"has_booking_detail"}),
    ("a@b", set()),
    ("1234 5678 9", {"has_booking_detail"}),
    ("12345678", set()),
    ("٠٥٠ ١٢٣ ٤٥٦٧", {"has_booking_detail"}),
    ("5521 رقم", {"has_tracking"}),
)


def test_unicode_signals(spark):
    df = stages.route(as_customer(spark, [t for t, _ in UNICODE_ROWS]), CONFIG)
    rows = {r["thread_idx"]: r for r in df.collect()}
    for i, (text, want) in enumerate(UNICODE_ROWS):
        assert {s for s in lx.SIGNALS if rows[i][s]} == want, text


def test_blank_and_length_limits(spark):
    texts = ["  ", "\x1c\x85\t", "great " + "x" * 193, "great " + "x" * 194, "x" * 71 + " a@bb.cc", "x" * 72 + " a@bb.cc"]
    assert [len(t) for t in texts[2:]] == [199, 200, 79, 80]
    rows = {r["thread_idx"]: r["router_reason"] for r in stages.route(as_customer(spark, texts), CONFIG).collect()}
    assert [rows[i] for i in range(6)] == [
        "empty_message", "empty_message", "positive_keyword_or_emoji", "no_confident_signal",
        "booking_detail_pattern", "no_confident_signal",
    ]


@pytest.mark.parametrize("k,sf", list(enumerate(("sf0.001", "sf0.01", "sf0.1"))))
def test_counts(spark, k, sf):
    sf_dir = str(Path(TESTDATA) / sf)
    staged = local_stages(sample.messages(spark, sf_dir), CONFIG, scores=sample.scores(spark, sf_dir))
    labelled = fill_with_standin(staged).cache()

    def counts(df, *cols):
        return {tuple(r[c] for c in cols): r["count"] for r in df.groupBy(*cols).count().collect()}

    def expected(table):
        return {(name,): values[k] for name, values in table.items() if values[k]}

    customer = labelled.where("author = 'customer'")
    assert counts(labelled.where("author <> 'system'"), "author") == expected(golden.AUTHORS)
    assert counts(customer, "router_reason") == expected(golden.STAGE_1_REASONS)
    tried = customer.where("sentiment_reason is not null").withColumn(
        "outcome", F.when(F.col("source") == "sentiment", F.col("label")).otherwise(F.col("sentiment_reason"))
    )
    assert counts(tried, "outcome") == expected(golden.STAGE_2_OUTCOMES)
    assert counts(labelled.where("source = 'api'"), "label") == expected(golden.STANDIN)
    assert labelled.where("confidence = 'low'").count() == golden.LOW_CONFIDENCE[k]

    documented = rollup.thread_summary(labelled, Precedence.DOCUMENTED)
    by_label_order = rollup.thread_summary(labelled, Precedence.LABEL_ORDER)
    assert documented.count() == golden.THREADS[k]
    assert counts(documented, "primary_label") == expected(golden.PRIMARY_DOCUMENTED)
    assert counts(by_label_order, "primary_label") == expected(golden.PRIMARY_LABEL_ORDER)
    both = documented.alias("a").join(by_label_order.alias("b"), "thread_idx")
    assert both.where("a.primary_label <> b.primary_label").count() == golden.ORDERS_DIFFER[k]

    # Invariants: one row per message, no locally made escalations, brand rows never judged.
    output = merge.labels_output(labelled)
    assert output.count() == sample.conversations(spark, sf_dir).count()
    assert output.select("id").distinct().count() == output.count()
    assert output.where("label = 'urgent_escalation'").count() == 0
    assert counts(output.where("`from` = 'brand'"), "confidence") == {("n/a",): golden.AUTHORS["brand"][k]}
    assert counts(output.where("`from` = 'system'"), "label", "confidence", "source", "reason").keys() == {("",) * 4}
    labelled.unpersist()
