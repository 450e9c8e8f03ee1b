"""Input tables of the queries, and small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from convroute.llm.words import slices


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_keys(*columns: str) -> dict[str, Column]:
    """``k1`` and ``k2``: 128 bits of hash of some columns, nulls being values of their own.

    The seeds come first, so that neither number is a function of the other.
    """
    parts = [part for name in columns for part in (F.isnull(name), F.col(name))]
    return {"k1": F.xxhash64(F.lit(1), *parts), "k2": F.xxhash64(F.lit(2), *parts)}


def map_texts(
    df: DataFrame,
    keys: dict[str, str],
    text: str,
    fields: Iterable[StructField],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """One output row per row: the ``keys`` (new name: column of ``df``), then ``fields`` computed from the text.

    ``make`` runs once per task and returns the function of one slice of texts (nulls are empty), which gives an
    array for each field.  Only keys and text are read, so other columns may have any name.
    """
    # A key that is the text itself is not sent twice.
    source = {name: "__text" if column == text else name for name, column in keys.items()}
    own = [F.col(column).alias(name) for name, column in keys.items() if column != text]
    chosen = df.select(*own, F.col(text).alias("__text"))
    fields = list(fields)
    kept = [StructField(name, chosen.schema[column].dataType) for name, column in source.items()]
    schema = StructType([*kept, *fields])
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column("__text").fill_null("")
                arrays = [part.column(source[name]) for name in names] + compute(texts)
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *(f.name for f in fields)])

    return chosen.mapInArrow(run, schema)
