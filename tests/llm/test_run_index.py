"""Earlier repeats by the run-length index, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import odd_rows
import pytest

from convroute.llm import run_index
from convroute.llm.run_index import IndexConfig, RunIndex


def brute(rows, window):
    """{(id, text): (n_bytes, n_removed, spans, kept)}, documents in order of id (nulls first), then of the text's hash."""

    def order(row):
        digest = hashlib.sha256(row[1]).digest()
        halves = [int.from_bytes(digest[a : a + 8], "big", signed=True) for a in (0, 8)]
        return row[0] is not None, row[0] or 0, halves

    seen, out = set(), {}
    for key in sorted({(i, (t or "").encode()) for i, t in rows}, key=order):
        text, gone = key[1], np.zeros(len(key[1]) + 1, bool)
        for p in range(len(text) - window + 1):
            if text[p : p + window] in seen:
                gone[p : p + window] = True
            seen.add(text[p : p + window])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out[key] = len(text), int(gone.sum()), spans, bytes(b for b, g in zip(text, gone) if not g)
    return out


def check(df, rows, config):
    got = run_index.remove_earlier_repeats(df, config).collect()
    want = brute(rows, config.window)
    plain = Counter((r.doc_id, r.n_bytes, r.n_removed, str([tuple(s) for s in r.spans]), bytes(r.kept)) for r in got)
    assert plain == Counter((i, w[0], w[1], str(w[2]), w[3]) for i, t in rows for w in [want[i, (t or "").encode()]])
    return got


@pytest.mark.parametrize(
    "config",
    [IndexConfig(), IndexConfig(window=9, anchor=4, longest=13, index_bytes=600, part_bytes=200), IndexConfig(window=5, anchor=5)],
)
def test_odd_rows(spark, config):
    rows = [(r[0], r[1]) for r in odd_rows.rows()]
    df = odd_rows.documents(spark)
    if config.window < 100:
        rows = [r for r in rows if r[1] is None or len(r[1]) < 10_000]
        df = df.where("text is null or length(text) < 10000")
    check(df, rows, config)


def test_split_buckets_and_periods(spark):
    """One passage among many texts, so that its bucket is split; periodic texts; bytes inside characters."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(12)) + passage[a : a + 150] + word() * 30 for a in range(40)]
    texts += ["ab" * 400, "ab" * 300 + "c" + "ab" * 200, "日本" * 200, "x" + "日本" * 150, "\x00" * 500, passage]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    whole = check(df, rows, IndexConfig())
    split = check(df, rows, IndexConfig(part_bytes=300, index_bytes=1))
    assert sorted(map(str, whole)) == sorted(map(str, split))


def test_one_row_many_times(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400))
    df = spark.range(20_000).selectExpr("1L as doc_id").withColumn("text", run_index.F.lit(text))
    more = spark.createDataFrame([(0, text[100:300])], "doc_id long, text string")
    got = run_index.remove_earlier_repeats(df.unionByName(more)).groupBy("doc_id", "n_removed").count().collect()
    assert {tuple(r) for r in got} == {(0, 0, 1), (1, 200, 20_000)}


@pytest.mark.parametrize("kind", ["string", "long"])
def test_ids_of_other_kinds(spark, kind):
    text = "0123456789" * 30
    df = spark.createDataFrame([("10", text), ("9", text[7:])], "doc_id string, text string")
    df = df.withColumn("doc_id", run_index.F.col("doc_id").cast(kind))
    got = {str(r[0]): r[2] for r in run_index.remove_earlier_repeats(df).collect()}
    assert got == ({"10": 290, "9": 293} if kind == "string" else {"9": 283, "10": 300})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, k1 int")
    assert run_index.remove_earlier_repeats(df).collect() == []


def test_index_is_the_run_length_transform():
    """Runs, samples and statistics against a sorted list of suffixes."""
    rng = random.Random(3)
    for size in (1, 2, 9, 40):
        strings = [bytes(rng.choice(b"\x00ab") for _ in range(rng.randint(1, 30))) * rng.randint(1, 3) for _ in range(size)]
        data = np.frombuffer(b"".join(s + b"\x00" for s in strings), np.uint8)
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        index = RunIndex.of(data, ends)
        places = [(n, p) for n, s in enumerate(strings) for p in range(len(s) + 1)]
        number = {place: i for i, place in enumerate(places)}
        order = sorted(places, key=lambda x: ([b + 1 for b in strings[x[0]][x[1] :]] + [0], x[0]))
        # Transform: the symbol before each suffix; the sign before a string is never in a run with another.
        signs = [strings[n][p - 1] + 1 if p else 0 for n, p in order]
        runs = []
        for sign in signs:
            if runs and sign and runs[-1][0] == sign:
                runs[-1][1] += 1
            else:
                runs.append([sign, 1])
        assert [list(map(int, run)) for run in zip(index.heads, index.lengths)] == runs
        length, before = index.matching_statistics(np.arange(len(data)))
        for (a, b) in zip(order, order[1:]):
            x, y = strings[a[0]][a[1] :], strings[b[0]][b[1] :]
            shared = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
            assert (length[number[b]], before[number[b]]) == (shared, number[a])
