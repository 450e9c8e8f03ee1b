"""Shape of physical plans."""

import re

import pytest

from convroute.config import RoutingConfig
from convroute.operators import requests
from convroute.plans import registry

PYTHON = {"sentiment_scores"}
LAZY = [
    "author_split", "first_n_threads", "message_context", "signals", "signals_documents", "router_stage",
    "residual_after_router", "sentiment_scores", "sentiment_stage", "residual_after_sentiment", "offline_model_labels",
    "brand_rows", "refine_candidates", "refine_pass", "thread_summary", "thread_summary_label_order",
    "label_distribution", "stage_coverage", "reason_breakdown", "seed_collision_audit",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {name: plan(registry.QUERIES[name](spark, sf_small)) for name in LAZY}


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_global_window(plans, name):
    text = plans[name]
    assert ("Python" in text or "ArrowEval" in text) == (name in PYTHON)
    assert "NestedLoop" not in text and "Cartesian" not in text
    windows = [line for line in text.split("\n") if re.search(r"[+:\- ]Window \[", line)]
    if name == "label_distribution":
        assert len(windows) == 1
    elif name == "message_context":
        assert len(windows) == 1 and "thread_idx" in windows[0]
        assert re.search(r"hashpartitioning\(thread_idx#\d+L, __chunk#\d+L", text)
    else:
        assert not windows


def test_filters_and_columns_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(conv_id,50\)", plans["first_n_threads"])
    assert "ReadSchema: struct<role:string>" in plans["author_split"]
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plans["signals_documents"]
    assert "ReadSchema: struct<conv_id:bigint>" in plans["seed_collision_audit"]
    assert "EqualTo(role,user)" in plans["sentiment_stage"]


def test_texts_are_searched_once(plans):
    for name in ("router_stage", "residual_after_router", "sentiment_stage", "thread_summary", "stage_coverage"):
        assert plans[name].count("lawyer") == plans["signals"].count("lawyer"), name


def test_no_shuffle_in_the_local_stages(plans):
    for name in ("signals", "router_stage", "residual_after_router", "brand_rows"):
        assert "Exchange" not in plans[name], name


def test_rollup_state_is_hashed_and_combined_before_the_shuffle(plans):
    text = plans["thread_summary"]
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "partial_bit_or" in text


def test_prices_are_broadcast(spark):
    calls = spark.range(5).selectExpr(
        "id AS batch", "concat('m', id) AS model", "id AS prompt_tokens", "id AS output_tokens", "id AS thinking_tokens"
    )
    assert "BroadcastHashJoin" in plan(requests.with_cost(calls, RoutingConfig()))
