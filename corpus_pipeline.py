"""A training corpus from raw documents, in stages that each write their table before the next one reads it.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, which has the columns of ``documents``.
All but the last return those columns:

1.  toxicity: documents that score as toxic go;
2.  SimHash near-duplicates: one document of each group stays, the one of the smallest id;
3.  substring dedup: words covered by repeated windows are cut out; a text that loses words is its kept words
    joined by one blank, one that loses nothing stays as it is, and ``n_chars`` counts what is left (a document
    may be left empty, but stays);
4.  benchmark decontamination: contaminated documents go;
5.  packing: what is left is packed into sequences of at most 1024 tokens.

Null texts stay null through stages 1 to 4 and are one end token in stage 5.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convroute.llm import decontaminate, packing, registry, simhash, substrings
from convroute.llm.tables import table
from convroute.workspace import Workspace, temporary_workspaces

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = registry.toxicity_scores(spark, docs, sf_dir, carry=COLUMNS[1:])
    return scores.where(F.col("score") < registry.TOXIC_FROM).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(docs, carry=COLUMNS[2:], untouched=True)
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).withColumnRenamed("kept_text", "text").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return registry.piece_rows(packing.pack(docs, registry.VOCABULARY))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("simhash", distinct),
    ("substrings", without_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Learning, fingerprints and tokens are beyond SQL; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another. A stage's table goes as soon as the next one is written."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        workspace = Workspace(spark, f"pipeline-{name}")
        with temporary_workspaces():
            docs = workspace.save(stage(spark, docs, sf_dir), "documents")
        if before:
            before.drop()
        before = workspace
    return STAGES[-1][1](spark, docs, sf_dir)
