"""Every registered query against its SQL twin."""

from functools import partial

import duckdb
import parity
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from convroute.plans import oracle, registry
from convroute.streaming import incremental

SURVEYED = 53


@pytest.fixture(scope="module")
def con(sf_small):
    return parity.connect(sf_small)


def test_every_query_has_a_twin():
    assert len(registry.QUERIES) == SURVEYED
    assert set(oracle.queries()) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry_points.queries())
    assert set(oracle.queries()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "label", "confidence", "reason"] and df.count() == 48


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_parity(spark, con, sf_small, name):
    got, want, _ = parity.compare(registry.QUERIES[name](spark, sf_small), con, oracle.queries()[name])
    assert got == want


@pytest.fixture(scope="module")
def dear(spark, tmp_path_factory):
    """Turns so long that asking about all undecided messages would cost several times the default budget."""
    folder = str(tmp_path_factory.mktemp("dear"))
    conversations = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    long = F.when(F.col("role") == "assistant", F.concat("text", F.repeat(F.lit("long "), 12_000))).otherwise(F.col("text"))
    conversations.withColumn("text", long).write.parquet(f"{folder}/conversations.parquet")
    own = duckdb.connect()
    own.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    return folder, own


@pytest.mark.parametrize("name", ["full_run", "refine_pass", "incremental_model_stage"])
def test_no_budget_stops_the_stand_in(spark, dear, monkeypatch, name):
    folder, own = dear
    one_by_one = partial(incremental.read_stream, max_files=1)
    monkeypatch.setattr(incremental, "read_stream", one_by_one)
    got, want, _ = parity.compare(registry.QUERIES[name](spark, folder), own, oracle.queries()[name])
    assert len(got) > 200 and got == want
