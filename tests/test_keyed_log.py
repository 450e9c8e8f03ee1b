"""The compacted result log: runs, look-ups without moving them, and merges that die half-way."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from convroute.operators import merge
from convroute.sinks import keyed_log
from convroute.sinks.result_log import append_slice
from convroute.sources.result_log import read_log

COLUMNS = (
    "id string, thread_idx long, seed_id long, turn_index long, platform string, author string, label string, "
    "confidence string, source string, reason string, batch long, asked string"
)


def rows(spark, keys, label, asked="q"):
    data = [(f"{t}:{i}", t, t, i, "x", "customer", label, "low", "api", "r", 0, f"{asked}{i % 3}") for t, i in keys]
    return spark.createDataFrame(data, COLUMNS)


def questions(spark, keys, asked="q"):
    data = [(t, i, f"{asked}{i % 3}") for t, i in keys]
    return spark.createDataFrame(data, "thread_idx long, turn_index long, asked string")


def files_by_bucket(log, run):
    found = {}
    for file in Path(log, "_runs", run.name).glob("*.parquet"):
        found.setdefault(file.name.split("_")[-1].split(".")[0], []).append(file)
    return found


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def below_exchanges(plan):
    """Lines of a printed plan that lie below an Exchange."""
    found, limit = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if limit is not None and depth > limit:
            found.append(line)
        elif "Exchange" in line:
            limit = depth
        else:
            limit = None
    return found


@pytest.fixture()
def filled(spark, tmp_path):
    """A third of all rows in one thread, twelve slices, some questions answered again."""
    log, random_ = str(tmp_path / "it's a log"), random.Random(5)
    keys = [(0, i) for i in range(100)] + [(t, i) for t in range(1, 51) for i in range(4)]
    random_.shuffle(keys)
    for n in range(10):
        append_slice(rows(spark, keys[n::10], f"l{n}"), log, "fp", f"s{n}")
    append_slice(rows(spark, keys[::7], "again"), log, "fp", "s10")
    append_slice(rows(spark, keys[::5], "other"), log, "other", "s11")
    return log, keys


def test_many_slices_become_one_file_a_bucket(spark, filled):
    log, keys = filled
    keyed_log.compact(spark, log, buckets=4)
    (run,) = keyed_log.log_parts(spark, log).runs
    assert run.buckets == 4 and run.rows == len(keys) + len(keys[::5])
    assert sorted(map(len, files_by_bucket(log, run).values())) == [1, 1, 1, 1]
    before = as_set(read_log(spark, log), "id", "fingerprint", "asked")
    assert as_set(keyed_log.read_compacted(spark, log), "id", "fingerprint", "asked") == sorted(set(before))
    keyed_log.compact(spark, log, buckets=4)
    assert keyed_log.log_parts(spark, log).runs == (run,)
    keyed_log.vacuum(spark, log)
    assert not list(Path(log).glob("fingerprint=*/slice=*"))
    assert keyed_log.read_compacted(spark, log).count() == run.rows


def test_look_ups_equal_those_of_the_plain_log(spark, filled):
    log, keys = filled
    asked = questions(spark, keys[:200] + [(9999, 1)]).unionByName(questions(spark, keys[200:250], "new"))

    def plain():
        all_rows = read_log(spark, log)
        columns = ("thread_idx", "turn_index", "asked", "label", "sequence")
        return (
            as_set(merge.pending(asked, all_rows, "fp"), "thread_idx", "turn_index", "asked"),
            as_set(merge.answered(asked, all_rows, "fp"), *columns),
        )

    def keyed():
        columns = ("thread_idx", "turn_index", "asked", "label", "sequence")
        return (
            as_set(keyed_log.pending(asked, log, "fp"), "thread_idx", "turn_index", "asked"),
            as_set(keyed_log.answered(asked, log, "fp"), *columns),
        )

    assert keyed() == plain()
    keyed_log.compact(spark, log, buckets=4)
    assert keyed() == plain()
    append_slice(rows(spark, keys[:3] + [(9999, 1)], "late"), log, "fp", "s12")
    keyed_log.compact(spark, log, buckets=8, fanout=1)
    assert [run.buckets for run in keyed_log.log_parts(spark, log).runs] == [8, 4]
    append_slice(rows(spark, keys[2:5], "latest"), log, "fp", "s13")
    want = plain()
    assert keyed() == want and len(want[0]) == 50
    assert ("late" in {r[3] for r in want[1]}) and ("latest" in {r[3] for r in want[1]})
    keyed_log.compact(spark, log, buckets=4, everything=True)
    assert len(keyed_log.log_parts(spark, log).runs) == 1 and keyed() == want


def test_runs_are_not_moved(spark, filled):
    log, keys = filled
    keyed_log.compact(spark, log, buckets=4)
    append_slice(rows(spark, keys[:9], "late"), log, "fp", "s12")
    keyed_log.compact(spark, log, buckets=4, fanout=1)
    assert len(keyed_log.log_parts(spark, log).runs) == 2
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        asked = questions(spark, keys)
        pending = keyed_log.pending(asked, log, "fp")._jdf.queryExecution().executedPlan().toString()
        answered = keyed_log.answered(asked, log, "fp")._jdf.queryExecution().executedPlan().toString()
        append_slice(rows(spark, keys[:5], "fresh"), log, "fp", "s13")
        with_fresh = keyed_log.pending(asked, log, "fp")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    # The questions move once, for both runs.
    assert pending.count("Exchange") == 1 and pending.count("Bucketed: true") == 2
    assert answered.count("Bucketed: true") == 2
    # The fresh slice moves, and nothing else does.
    assert with_fresh.count("Exchange") == 2 and with_fresh.count("Bucketed: true") == 2
    for plan in (pending, answered, with_fresh):
        assert not any("Bucketed: true" in line for line in below_exchanges(plan))


def test_runs_grow_by_size(spark, tmp_path):
    log, written = str(tmp_path / "log"), 0
    for n in range(12):
        append_slice(rows(spark, [(n, i) for i in range(10)], "l"), log, "fp", f"s{n}")
        keyed_log.compact(spark, log, buckets=2, fanout=2)
        sizes = [run.rows for run in keyed_log.log_parts(spark, log).runs]
        written += sizes[0]
        assert sum(sizes) == 10 * (n + 1)
        assert all(small * 2 < large for small, large in zip(sizes, sizes[1:]))
    assert written <= 10 * 12 * 4
    assert keyed_log.read_compacted(spark, log).count() == 120


def test_a_merge_that_dies_before_the_switch_loses_nothing(spark, filled, monkeypatch):
    log, keys = filled
    keyed_log.compact(spark, log, buckets=4)
    append_slice(rows(spark, keys[:9], "late"), log, "fp", "s12")
    parts = keyed_log.log_parts(spark, log)
    want = as_set(keyed_log.read_compacted(spark, log), "id", "fingerprint", "asked", "label")
    with monkeypatch.context() as broken:
        broken.setattr(keyed_log, "_switch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            keyed_log.compact(spark, log, buckets=4)
    # A manifest that was cut off has no mark of success.
    cut = Path(log, "_manifest", "version=9999999999999999999")
    cut.mkdir()
    (cut / "part-0.json").write_text(json.dumps({"kind": "run", "name": "run=0", "number": 1, "buckets": 1}))
    assert keyed_log.log_parts(spark, log) == parts
    assert as_set(keyed_log.read_compacted(spark, log), "id", "fingerprint", "asked", "label") == want
    keyed_log.compact(spark, log, buckets=4)
    keyed_log.vacuum(spark, log)
    after = keyed_log.log_parts(spark, log)
    assert {p.name for p in Path(log, "_runs").iterdir()} == {run.name for run in after.runs} and not after.fresh


def test_a_slice_written_again_is_fresh_again(spark, filled):
    log, keys = filled
    keyed_log.compact(spark, log, buckets=4)
    append_slice(rows(spark, [(7777, 0)], "more"), log, "fp", "s0")
    assert [name for name, _ in keyed_log.log_parts(spark, log).fresh] == ["fingerprint=fp/slice=s0"]
    assert keyed_log.pending(questions(spark, [(7777, 0)]), log, "fp").count() == 0


def test_a_session_that_does_not_know_the_run(spark, filled):
    log, keys = filled
    keyed_log.compact(spark, log, buckets=4)
    (run,) = keyed_log.log_parts(spark, log).runs
    spark.sql(f"DROP TABLE {keyed_log._table_name(keyed_log._run_folder(log, run.name))}")
    assert keyed_log.read_compacted(spark, log).count() == run.rows
    assert keyed_log.pending(questions(spark, keys), log, "fp").count() == 0


def test_missing_and_empty_logs(spark, tmp_path):
    log, asked = str(tmp_path / "none"), questions(spark, [(1, 1)])
    keyed_log.compact(spark, log)
    keyed_log.vacuum(spark, log)
    assert keyed_log.read_compacted(spark, log).isEmpty()
    assert keyed_log.pending(asked, log, "fp").count() == 1 and keyed_log.answered(asked, log, "fp").count() == 0
    append_slice(rows(spark, [(1, 1)], "l").limit(0), log, "fp", "empty")
    keyed_log.compact(spark, log, buckets=2)
    assert keyed_log.read_compacted(spark, log).where(F.lit(True)).count() == 0
    assert keyed_log.pending(asked, log, "fp").count() == 1 and keyed_log.answered(asked, log, "fp").count() == 0
