"""Token counts of every prefix of every text (operator 3).

``prefix_counts`` runs the dynamic programme of ``byte_bpe.PrefixCounts`` once over each whole text and stores
its result: one signed byte per byte of text, whose running sum is the exact token count of the prefix that ends
there.  ``tokens_before`` and ``within_budget`` answer from the stored column alone; no text is encoded again.

Null and empty texts have no prefix, 0 bytes and 0 tokens.  Repeated rows give repeated results; null ids pass
through.  There is no shuffle: each task reads its split in slices of about 1 MB of text, however long a table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from convroute.llm.byte_bpe import PrefixCounts, UnitValues
from convroute.llm.tables import map_texts

_values: dict[str, UnitValues] = {}


def _unit_values(vocabulary: str) -> UnitValues:
    """The automaton and the kept units live as long as the Python worker."""
    if vocabulary not in _values:
        _values[vocabulary] = UnitValues(PrefixCounts(vocabulary).increments)
    return _values[vocabulary]


def prefix_counts(df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, prefix_increments) for each row."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        values = _unit_values(vocabulary)

        def compute(texts: pa.Array) -> list[pa.Array]:
            increments = values.of(texts.to_pylist())
            totals = [int(np.frombuffer(x, np.int8).sum(dtype=np.int64)) for x in increments]
            return [
                pa.array([len(x) for x in increments], pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(increments, pa.binary()),
            ]

        return compute

    fields = [
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("prefix_increments", BinaryType()),
    ]
    return map_texts(df, {id_column: id_column}, text_column, fields, make)


@F.pandas_udf(LongType())
def tokens_before(increments: pd.Series, position: pd.Series) -> pd.Series:
    """Tokens of the prefix of ``position`` bytes (a character border); beyond the end, of the whole text."""
    return pd.Series(
        [
            int(np.frombuffer(x, np.int8)[: max(0, int(p))].sum(dtype=np.int64))
            for x, p in zip(increments, position, strict=True)
        ],
        dtype="int64",
    )


def within_budget(budget: int) -> Callable[[Column, Column], Column]:
    """A function of (prefix_increments, text): bytes of the longest prefix of at most ``budget`` tokens."""

    @F.pandas_udf(LongType())
    def longest(increments: pd.Series, text: pd.Series) -> pd.Series:
        out = []
        for x, t in zip(increments, text, strict=True):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            counts = np.cumsum(np.frombuffer(x, np.int8), dtype=np.int64)
            # A prefix may end where no continuation byte follows.
            border = np.ones(len(raw), bool)
            border[:-1] = (raw[1:] & 0xC0) != 0x80
            good = np.flatnonzero(border & (counts <= budget))
            out.append(int(good[-1]) + 1 if len(good) else 0)
        return pd.Series(out, dtype="int64")

    return longest
