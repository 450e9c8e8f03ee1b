"""Messages bucketed by thread: same rows, no shuffle of texts."""

import re

import pytest
from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.operators import context, rollup, stages
from convroute.plans import registry, sample
from convroute.sinks import message_store

SHORT = RoutingConfig(chunk_turns=4, context_turns=2)


@pytest.fixture(scope="module")
def flat(spark):
    """Threads of 1 to 40 turns, one of them with a third of all rows, in an order of their own."""
    turns = spark.range(12).select(F.col("id").alias("thread_idx"), F.when(F.col("id") == 7, 400).otherwise(F.col("id") * 3 + 1).alias("n"))
    rows = turns.select("thread_idx", F.explode(F.expr("sequence(0, CAST(n AS INT) - 1)")).alias("turn_index"))
    author = F.when(F.col("turn_index") % 2 == 0, "customer").when(F.col("turn_index") % 5 != 0, "brand")
    text = F.when(F.col("turn_index") % 11 != 3, F.concat_ws(" ", F.lit("said"), "thread_idx", "turn_index"))
    return rows.select("*", author.alias("author"), text.alias("text")).orderBy(F.xxhash64("thread_idx", "turn_index"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def exchanged(df):
    """The columns that each exchange of the plan moves."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\n", text)


@pytest.mark.parametrize("turns", [0, 1, 2, 4])
def test_context_of_long_and_short_threads(spark, flat, tmp_path, turns):
    config = RoutingConfig(chunk_turns=4, context_turns=turns)
    store = message_store.write_messages(flat, str(tmp_path / "store"), config, 5)
    assert rows(store.messages().drop("chunk")) == rows(flat)
    assert rows(store.with_context(config).drop("chunk")) == rows(context.with_context(flat, config))


def test_a_store_lends_no_more_turns_than_it_was_written_for(spark, flat, tmp_path):
    store = message_store.write_messages(flat, str(tmp_path / "store"), SHORT, 5)
    assert rows(store.with_context(RoutingConfig(context_turns=1)).drop("chunk")) == rows(
        context.with_context(flat, RoutingConfig(context_turns=1))
    )
    with pytest.raises(ValueError, match="lends 2 turns"):
        store.with_context(RoutingConfig(context_turns=3))


def test_a_missing_turn_fails(spark, flat, tmp_path):
    store = message_store.write_messages(flat.where("thread_idx != 5 or turn_index != 6"), str(tmp_path / "store"), SHORT, 5)
    with pytest.raises(Exception, match="no turn just before 5:7"):
        store.with_context(SHORT).collect()


def test_a_hot_thread_is_spread_and_each_bucket_is_one_file(spark, flat, tmp_path):
    store = message_store.write_messages(flat, str(tmp_path / "store"), SHORT, 8)
    hot = store.messages().where("thread_idx = 7").groupBy(F.input_file_name()).count().collect()
    assert len(hot) == 8 and max(r["count"] for r in hot) < 200
    assert len(list((tmp_path / "store" / "messages").glob("*.parquet"))) <= 8


def test_another_session_opens_the_store(spark, flat, tmp_path):
    path = str(tmp_path / "store")
    store = message_store.write_messages(flat, path, SHORT, 4)
    keys = flat.select("thread_idx", "turn_index", F.lit(0.5).alias("score"))
    store.add("scores", keys)
    for table in spark.catalog.listTables("default"):
        if table.name.startswith("convroute_store_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = message_store.open_store(spark, path)
    assert (again.buckets, again.chunk_turns, again.lent_turns) == (4, 4, 2)
    assert rows(again.attach(again.messages(), "scores").drop("chunk")) == rows(flat.withColumn("score", F.lit(0.5)))
    with pytest.raises(ValueError, match="has a table"):
        again.add("scores", keys)


def test_no_layout_no_store(spark, flat, tmp_path):
    store = message_store.write_messages(flat, str(tmp_path / "store"), SHORT, 4)
    empty = message_store.write_messages(flat.limit(0), str(tmp_path / "empty"), SHORT, 4)
    assert empty.with_context(SHORT).collect() == []
    assert rows(store.attach_rows(store.messages(), flat.limit(0).select("thread_idx", "turn_index", F.lit(1).alias("x"))).drop("chunk", "x")) == rows(flat)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        message_store.open_store(spark, str(tmp_path / "none"))


def test_texts_stay_where_they_are(spark, sf_small, no_broadcast):
    store = registry._store(spark, sf_small, "store-plan")
    with_context = store.with_context(registry.CONFIG)
    assert exchanged(with_context) == []
    with message_store.co_located(spark):
        scored = store.attach(stages.route(with_context, registry.CONFIG), "scores")
        assert exchanged(scored) == []
        labelled = registry._stored_labels(store)
        moved = exchanged(labelled)
        assert len(moved) == 1 and "text#" not in moved[0] and "context#" not in moved[0]
        moved = exchanged(rollup.thread_summary(labelled))
        assert len(moved) == 2 and all("text#" not in columns and "context#" not in columns for columns in moved)
    # The same from files in any order moves texts.
    staged = stages.join_scores(
        stages.route(context.with_context(sample.messages(spark, sf_small)), registry.CONFIG),
        sample.scores(spark, sf_small),
    )
    assert any("text#" in columns for columns in exchanged(staged))
