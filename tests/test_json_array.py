"""Files of one JSON array, read by many tasks."""

import json
import random

import pytest

from convroute.sources import json_array
from convroute.sources import threads as src
from convroute.workspace import Workspace

NASTY = ['"', "\\", '\\"', "{", "}", "[", "]", '"}', '\\\\"', "},{", "é", "日本", "\n", "a", "b ", '"]}', "\\u007d", "\U0001f600", ""]


def threads(n, seed=0):
    rng = random.Random(seed)
    say = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 12)))
    return [
        {
            "seed_id": i % 7,
            "platform": say(),
            "customer_name": say(),
            "messages": [{"from": rng.choice(["customer", "brand"]), "text": say() or None} for _ in range(rng.randint(0, 5))],
        }
        for i in range(n)
    ]


@pytest.fixture
def small_ranges(spark):
    """Sets the bytes of one range."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: (spark.conf.set(key, str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def flat(spark, path, format):
    rows = src.number_threads(src.read_threads(spark, str(path), format), Workspace(spark, "test"))
    return sorted(map(str, src.flatten_threads(rows).collect()))


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("escape", [True, False])
def test_every_cut(spark, tmp_path, small_ranges, indent, escape):
    """One file, in ranges of so few bytes that every sign falls on a border of some reading."""
    rows = threads(25)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=escape), encoding="utf-8")
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    want = flat(spark, tmp_path / "a.jsonl", "json")
    assert len(want) > 40
    for size in (64, 71, 4096):
        small_ranges(size)
        objects = json_array.read_objects(spark, str(tmp_path / "a.json"))
        got = {r.row_index: json.loads(r.value) for r in objects.collect()}
        assert [got[i] for i in range(len(rows))] == rows and len(got) == len(rows)
    small_ranges(150)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 8
    assert flat(spark, tmp_path / "a.json", "json_array") == want


def test_every_border_of_a_range():
    """Summaries of the two halves of a text, for every place to cut it, give the state of the whole."""
    text = json.dumps(threads(4, seed=3), ensure_ascii=False)
    segments = text.split("}")
    for cut in range(1, len(segments)):
        halves = []
        for number, part in enumerate((segments[:cut], segments[cut:])):
            summary = json_array._Summary()
            for segment in part:
                summary.add(segment)
            halves.append(summary.row(("f", number)))
        inside, depth, ended = json_array.compose(halves)["f", 1]
        before = "}".join(segments[:cut]) + "}"
        in_string, deep, done, i = False, 0, 0, 0
        while i < len(before):
            c = before[i]
            if c == "\\":
                i += 1
            elif c == '"':
                in_string = not in_string
            elif not in_string:
                deep += (c in "[{") - (c in "]}")
                done += c == "}" and deep == 1
            i += 1
        assert (inside, depth, ended) == (in_string, deep, done)


def test_several_files_and_empty_arrays(spark, tmp_path, small_ranges):
    rows = threads(30, seed=5)
    (tmp_path / "a").mkdir()
    (tmp_path / "l").mkdir()
    for name, part in (("1", rows[:9]), ("2", []), ("3", rows[9:])):
        (tmp_path / "a" / name).write_text(" " + json.dumps(part, indent=1) + "\n")
        (tmp_path / "l" / name).write_text("\n".join(map(json.dumps, part)))
    (tmp_path / "a" / "4").write_text("")
    small_ranges(200)
    assert flat(spark, tmp_path / "a", "json_array") == flat(spark, tmp_path / "l", "json")


def test_a_long_object_over_many_ranges(spark, tmp_path, small_ranges):
    rows = threads(3) + [{"seed_id": 1, "platform": "}" * 3000 + '"' * 3000, "messages": []}] + threads(3, seed=2)
    (tmp_path / "a.json").write_text(json.dumps(rows))
    small_ranges(100)
    got = {r.row_index: json.loads(r.value) for r in json_array.read_objects(spark, str(tmp_path / "a.json")).collect()}
    assert [got[i] for i in range(len(rows))] == rows


@pytest.mark.parametrize("damage", [lambda t: t[:-1], lambda t: t[:-40], lambda t: t + "]", lambda t: t.replace('"', "", 1)])
def test_broken_arrays_fail(spark, tmp_path, damage):
    (tmp_path / "a.json").write_text(damage(json.dumps(threads(20))))
    with pytest.raises(ValueError, match="whole JSON array"):
        json_array.read_objects(spark, str(tmp_path / "a.json")).collect()
