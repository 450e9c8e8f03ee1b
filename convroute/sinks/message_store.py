"""Messages kept where they are needed: a store bucketed by thread, and tables laid beside it the same way.

Context, a table of scores, labels of a classifier and the rollup all meet messages by thread.  From files in any order
each of these shuffles all texts.  ``write_messages`` shuffles them once; what reads the store after that finds the
messages of a thread in one task and moves narrow rows only.

Threads are cut into *chunks* of ``chunk_turns`` turns, and buckets go by thread and chunk, so a thread with a large
share of all messages is spread like many small ones.  The last turns of a chunk are stored again in the next one,
marked ``lent``: the context of a chunk's first turns lies in its own bucket.  There is one file per bucket, in order of
thread, chunk and turn.

Joins find their rows in place while ``co_located`` holds.  Buckets go by thread and chunk, as context needs them, joins
by the turn as well, and Spark by default shuffles both sides unless these are the same.

``_layout`` beside the tables tells buckets, turns and columns, and is written last: a store whose writing died has none
and can't be opened.  Sessions whose catalog doesn't know a table yet register it by its folder.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convroute.config import RoutingConfig
from convroute.operators.context import prior_turns

CHUNK = ("thread_idx", "chunk")
PLACE = (*CHUNK, "turn_index")

_LAYOUT = "name string, buckets int, chunk_turns int, lent_turns int, schema string"


def _table_name(folder: str) -> str:
    return f"convroute_store_{hashlib.md5(folder.encode()).hexdigest()}"


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """Plan, and so run, what joins tables of a store inside: neither side of such a join moves."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _chunk(chunk_turns: int) -> Column:
    return F.floor(F.col("turn_index") / chunk_turns).cast("bigint").alias("chunk")


def _write_bucketed(rows: DataFrame, folder: str, buckets: int) -> None:
    """Each task writes the one file of its bucket."""
    (
        rows.repartition(buckets, *CHUNK)
        .write.format("parquet")
        .bucketBy(buckets, *CHUNK)
        .sortBy(*PLACE)
        .option("path", folder)
        .saveAsTable(_table_name(folder))
    )


@dataclass(frozen=True)
class MessageStore:
    """An open store.  ``tables`` are those laid beside the messages, by name, with their schemas."""

    spark: SparkSession
    path: str
    buckets: int
    chunk_turns: int
    lent_turns: int
    tables: dict[str, T.StructType]

    def _read(self, name: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        table = _table_name(folder)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.tables[name])
            quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(CHUNK)}) "
                f"SORTED BY ({', '.join(PLACE)}) INTO {self.buckets} BUCKETS LOCATION '{quoted}'"
            )
        return self.spark.table(table)

    def messages(self) -> DataFrame:
        """Every message once, with its ``chunk``."""
        return self._read("messages").where("not lent").drop("lent")

    def with_context(self, config: RoutingConfig = RoutingConfig()) -> DataFrame:
        """``context.with_context`` of the stored messages, without a shuffle."""
        if config.context_turns > self.lent_turns:
            raise ValueError(f"the store lends {self.lent_turns} turns to the next chunk: too few for this context")
        found = prior_turns(Window.partitionBy(*CHUNK).orderBy("turn_index"), config.context_turns, ~F.col("lent"))
        return self._read("messages").withColumn("context", found).where("not lent").drop("lent")

    def add(self, name: str, rows: DataFrame) -> MessageStore:
        """Lay a table with one row per message at most beside the messages; returns the store that knows it."""
        if name in self.tables:
            raise ValueError(f"the store has a table {name}")
        placed = rows.withColumn("chunk", _chunk(self.chunk_turns))
        _write_bucketed(placed, f"{self.path}/{name}", self.buckets)
        _write_layout(self, name, placed.schema)
        return open_store(self.spark, self.path)

    def attach(self, messages: DataFrame, name: str) -> DataFrame:
        """Left join of messages of the store with a table laid beside it: neither side moves, if ``co_located``."""
        return messages.join(self._read(name), list(PLACE), "left")

    def attach_rows(self, messages: DataFrame, rows: DataFrame) -> DataFrame:
        """Left join with rows that lie anywhere, keyed by message: these are dealt like the store, messages stay, if ``co_located``."""
        dealt = rows.withColumn("chunk", _chunk(self.chunk_turns)).repartition(self.buckets, *CHUNK)
        return messages.join(dealt, list(PLACE), "left")


def _write_layout(store: MessageStore, name: str, schema: T.StructType) -> None:
    row = [(name, store.buckets, store.chunk_turns, store.lent_turns, schema.json())]
    store.spark.createDataFrame(row, _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{store.path}/_layout/{name}")


def write_messages(
    messages: DataFrame, path: str, config: RoutingConfig = RoutingConfig(), buckets: int = 1024
) -> MessageStore:
    """Store messages, keyed by thread and turn.  The one shuffle of texts: choose ``buckets`` so that one fits a task."""
    turns, size = config.context_turns, config.chunk_turns
    if turns > size:
        raise ValueError("context_turns must not exceed chunk_turns: context comes from the chunk before at most")
    home = _chunk(size)
    lent = F.col("turn_index") % size >= size - turns
    place = lambda chunk, is_lent: F.struct(chunk.alias("chunk"), F.lit(is_lent).alias("lent"))
    places = F.when(lent, F.array(place(home, False), place(home + 1, True))).otherwise(F.array(place(home, False)))
    rows = messages.select("*", F.inline(places))
    spark = messages.sparkSession
    _write_bucketed(rows, f"{path}/messages", buckets)
    _write_layout(MessageStore(spark, path, buckets, size, turns, {}), "messages", rows.schema)
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> MessageStore:
    # One row per table of the store.
    found = spark.read.schema(_LAYOUT).json(f"{path}/_layout/*").collect()
    layout = next(row for row in found if row["name"] == "messages")
    schemas = {row["name"]: T.StructType.fromJson(json.loads(row["schema"])) for row in found}
    return MessageStore(
        spark, path, layout["buckets"], layout["chunk_turns"], layout["lent_turns"], schemas
    )
