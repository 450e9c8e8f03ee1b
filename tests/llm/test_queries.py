"""Registered queries: SQL twins, held-out accuracy, and the pipeline against a brute-force version."""

import sys
from collections import Counter
from pathlib import Path

import brute
import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from convroute.llm import registry

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from parity import compare, connect  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_its_sql(spark, sf_small, name):
    got, want, differences = compare(registry.QUERIES[name](spark, sf_small), connect(sf_small), registry.ORACLE_SQL[name])
    assert got and len(got) == len(want) and not differences


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))


@pytest.mark.parametrize("name, label, share", [("op4_toxicity", "toxic", 0.93), ("op8_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, share):
    folder = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall())
    rows = registry.QUERIES[name](spark, folder).where("held_out").collect()
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert len(known) > 500
    assert sum(a == b for a, b in known) >= share * len(known)


def test_pipeline(spark, sf_small):
    """Stage by stage, each against a restatement on the rows that came in."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_small}/benchmark.parquet'").fetchall()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash", "substrings", "decontamination", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, sf_small).cache()
        texts = {r.doc_id: r.text for r in after.collect()} if name != "packing" else {}
        if name == "toxicity":
            scores = registry.toxicity_scores(spark, docs, sf_small).collect()
            want = {r.doc_id: before[r.doc_id] for r in scores if r.score < 0.5}
        elif name == "simhash":
            keys = sorted(before)
            prints = np.array([brute.fingerprint(before[k]) for k in keys], np.uint64)
            label = brute.components(len(keys), lambda i, j: int(np.bitwise_count(prints[i] ^ prints[j])) <= 3)
            want = {keys[g]: before[keys[g]] for g in set(label)}
        elif name == "substrings":
            kept = brute.kept_words(list(before.values()), 35)
            want = {k: w[2] if w[1] else before[k] for k, w in zip(before, kept)}
            assert all(r.n_chars == len(r.text) for r in after.collect() if r.text != before[r.doc_id])
        elif name == "decontamination":
            found = brute.contamination(list(before.values()), items)
            want = {k: before[k] for k, (n, hit, _) in zip(before, found) if not (hit and 20 * hit >= n)}
        else:
            tokenizer = Tokenizer.from_file(registry.VOCABULARY)
            sizes = Counter()
            for row in after.collect():
                sizes[row.doc_id] += row.length
            assert sizes == {k: len(tokenizer.encode(t or "").ids) + 1 for k, t in before.items()}
            break
        assert texts == want
        assert after.columns == docs.columns
        docs = after
    whole = corpus_pipeline.run(spark, sf_small)
    shown = ("doc_id", "start", "length", "ids_crc32")
    tokens = lambda df: sum(r.length for r in df.select(*shown).collect())
    assert tokens(whole) == tokens(after)
