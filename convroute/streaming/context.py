"""Context of messages that arrive as flat rows, in any order and over any number of micro-batches.

A message is given out as soon as the turns before it that serve as its context are known.  What has to wait for
that is kept as state of the thread: messages whose prior turns have not arrived yet (the reorder buffer), and the lines
of turns that later ones may still need.  A long thread is many keys of ``chunk_turns`` turns each, so no task and no
state holds more than that; the last turns of a chunk are lent to the next one, as in the batch form.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from convroute.config import RoutingConfig

_OUT = "payload string, context array<string>"
_STATE = "state string"


class ChunkState:
    """What is known of one chunk of a thread."""

    def __init__(self, turns: int, stored: str | None = None):
        self.turns = turns
        known = json.loads(stored) if stored else {"done": [], "lines": {}, "waiting": {}}
        #: Turns given out, as ranges [begin, end).
        self.done: list[list[int]] = known["done"]
        self.lines: dict[int, str] = {int(k): v for k, v in known["lines"].items()}
        self.waiting: dict[int, str] = {int(k): v for k, v in known["waiting"].items()}

    def stored(self) -> str:
        return json.dumps({"done": self.done, "lines": self.lines, "waiting": self.waiting}, ensure_ascii=False)

    def is_done(self, turn: int) -> bool:
        return any(a <= turn < b for a, b in self.done)

    def add(self, turn: int, line: str, payload: str | None) -> None:
        """A turn, with its message if it is this chunk's own. A turn that was given out already changes nothing."""
        if self.is_done(turn):
            return
        self.lines.setdefault(turn, line)
        if payload is not None:
            self.waiting.setdefault(turn, payload)

    def ready(self, all_of_it: bool = False) -> Iterator[tuple[str, list[str]]]:
        """Messages whose context is complete; with ``all_of_it`` the others too, with what is known."""
        out = []
        for turn in sorted(self.waiting):
            prior = range(max(0, turn - self.turns), turn)
            if all_of_it or all(p in self.lines for p in prior):
                yield self.waiting.pop(turn), [self.lines[p] for p in prior if p in self.lines]
                out.append([turn, turn + 1])
        merged: list[list[int]] = []
        for a, b in sorted(self.done + out):
            if merged and merged[-1][1] >= a:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        self.done = merged
        # A line goes once every turn that it could serve has been given out.
        needed = lambda turn: any(not self.is_done(t) for t in range(turn + 1, turn + 1 + self.turns))
        self.lines = {t: line for t, line in self.lines.items() if needed(t) or t in self.waiting}


def with_arriving_context(
    messages: DataFrame, config: RoutingConfig = RoutingConfig(), wait_ms: int | None = None
) -> DataFrame:
    """Add ``context`` to a stream of messages; equals ``operators.context.with_context`` once all turns are in.

    A turn that arrives again is given out once.  A message whose prior turns never arrive waits; after ``wait_ms``
    without news of its chunk it is given out with the context that is known, and the
    chunk is forgotten.  Without ``wait_ms`` nothing is given out incomplete and nothing is forgotten.
    """
    turns, size = config.context_turns, config.chunk_turns
    if turns > size:
        raise ValueError("context_turns must not exceed chunk_turns: context comes from the chunk before at most")
    home = F.floor(F.col("turn_index") / size).cast("bigint")
    lent = F.col("turn_index") % size >= size - turns
    line = F.concat(F.coalesce("author", F.lit("None")), F.lit(": "), F.coalesce("text", F.lit("None")))
    rows = messages.select(
        "thread_idx",
        F.explode(F.when(lent, F.array(home, home + 1)).otherwise(F.array(home))).alias("chunk"),
        home.alias("home"),
        F.col("turn_index").cast("bigint").alias("turn"),
        line.alias("line"),
        F.to_json(F.struct(*messages.columns)).alias("payload"),
    ).withColumn("payload", F.when(F.col("chunk") == F.col("home"), F.col("payload")))
    timeout = GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chunk = ChunkState(turns, state.get[0] if state.exists else None)
        if state.hasTimedOut:
            found = list(chunk.ready(all_of_it=True))
            state.remove()
        else:
            for batch in batches:
                for turn, text, payload in zip(batch["turn"], batch["line"], batch["payload"], strict=True):
                    chunk.add(int(turn), text, payload if isinstance(payload, str) else None)
            found = list(chunk.ready())
            state.update((chunk.stored(),))
            if wait_ms is not None:
                state.setTimeoutDuration(wait_ms)
        if found:
            yield pd.DataFrame({"payload": [p for p, _ in found], "context": [c for _, c in found]})

    found = rows.drop("home").groupBy("thread_idx", "chunk").applyInPandasWithState(advance, _OUT, _STATE, "append", timeout)
    schema = T.StructType(messages.schema.fields)
    return found.select(F.from_json("payload", schema).alias("m"), "context").select("m.*", "context")
