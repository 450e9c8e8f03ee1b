"""Context of messages that arrive in any order: equal to the batch form, over triggers and restarts."""

import random
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.operators import context
from convroute.plans import sample
from convroute.streaming import incremental
from convroute.streaming.context import ChunkState

CONFIG = replace(RoutingConfig(), chunk_turns=4)


def rows(df):
    return sorted(map(str, df.select("id", "text", "turn_index", "context").collect()))


def long_and_short(spark, sf_dir):
    """The sample's messages, and one thread with many turns."""
    messages = sample.messages(spark, sf_dir).where("thread_idx < 25")
    hot = spark.range(60).select(
        F.concat(F.lit("900:"), "id").alias("id"), F.lit(900).cast("long").alias("thread_idx"), F.lit(1).cast("long").alias("seed_id"),
        F.col("id").alias("turn_index"), F.lit("x").alias("platform"), F.lit("customer").alias("author"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit('say "'), "id")).alias("text"), F.lit("c").alias("customer_name"),
    )
    return messages.select(*hot.columns).unionByName(hot)


def advance(spark, source, out, checkpoint, schema, **more):
    arriving = incremental.read_stream(spark, source, schema, max_files=1)
    incremental.start_context(arriving, out, checkpoint, CONFIG, **more).awaitTermination()
    return spark.read.parquet(out)


def test_shuffled_files_triggers_and_a_restart(spark, sf_small, tmp_path):
    messages = long_and_short(spark, sf_small).cache()
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spread = messages.withColumn("__file", F.pmod(F.xxhash64("id"), F.lit(3)))
    want = rows(context.with_context(messages, CONFIG))
    spread.where("__file < 2").drop("__file").repartition(2, "id").write.parquet(source)
    early = rows(advance(spark, source, out, checkpoint, messages.schema))
    assert 0 < len(early) < len(want) and set(early) <= set(want)
    # The rest, and a file that brings turns again.
    spread.where("__file = 2 or turn_index % 3 = 0").drop("__file").coalesce(1).write.mode("append").parquet(source)
    assert rows(advance(spark, source, out, checkpoint, messages.schema)) == want
    assert rows(advance(spark, source, out, checkpoint, messages.schema)) == want


def test_a_turn_that_never_comes(spark, tmp_path, sf_small):
    messages = long_and_short(spark, sf_small).where("thread_idx = 900 and turn_index in (0, 1, 3)").coalesce(1).cache()
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    messages.write.parquet(source)
    found = advance(spark, source, out, checkpoint, messages.schema)
    assert [r.id for r in found.orderBy("id").collect()] == ["900:0", "900:1"]
    out, checkpoint = str(tmp_path / "out2"), str(tmp_path / "check2")
    arriving = incremental.read_stream(spark, source, messages.schema)
    query = incremental.start_context(arriving, out, checkpoint, CONFIG, wait_ms=500)
    try:
        for _ in range(60):
            time.sleep(1)
            late = spark.read.schema(found.schema).parquet(out).where("turn_index = 3").collect() if Path(out).exists() else []
            if late:
                break
    finally:
        query.stop()
    assert [r.context for r in late] == [["customer: say \"1"]]


def test_state_of_a_chunk():
    """Any order of arrival, stored and read in between, gives each turn once with its context, and keeps few lines."""
    rng = random.Random(2)
    for turns in (0, 1, 2, 5):
        arrivals = [t for t in range(40) for _ in range(rng.randint(1, 2))]
        rng.shuffle(arrivals)
        stored, found = None, {}
        for turn in arrivals:
            state = ChunkState(turns, stored)
            state.add(turn, f"a: {turn}", str(turn))
            for payload, prior in state.ready():
                assert payload not in found
                found[payload] = prior
            stored = state.stored()
        assert found == {str(t): [f"a: {p}" for p in range(max(0, t - turns), t)] for t in range(40)}
        state = ChunkState(turns, stored)
        assert state.done == [[0, 40]] and sorted(state.lines) == list(range(40 - turns, 40)) and not state.waiting
