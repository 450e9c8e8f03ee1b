"""Sources, sinks and the result log."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from convroute.config import RoutingConfig
from convroute.operators import context, merge
from convroute.operators.standin import fill_with_standin
from convroute.plans import sample
from convroute.plans.run import local_stages
from convroute.sinks import tables
from convroute.sources import result_log
from convroute.sources import threads as src
from convroute.workspace import Workspace, shared_folder

CORPUS = [
    {"seed_id": 9, "platform": "x", "customer_name": "سارة", "messages": [
        {"from": "customer", "text": "وين طلبي؟"}, {"from": "brand", "text": None}, {"from": "customer"},
        {"from": "customer", "text": 'a "quoted"\n line, \\ back'}]},
    {"seed_id": 9, "messages": []},
    {"seed_id": 3, "platform": None, "messages": [{"from": "brand", "text": "hi"}]},
]

FLAT = [
    ("0:0", 0, 9, 0, "x", "customer", "وين طلبي؟", "سارة", []),
    ("0:1", 0, 9, 1, "x", "brand", "", "سارة", ["customer: وين طلبي؟"]),
    ("0:2", 0, 9, 2, "x", "customer", "", "سارة", ["customer: وين طلبي؟", "brand: None"]),
    ("0:3", 0, 9, 3, "x", "customer", 'a "quoted"\n line, \\ back', "سارة", ["brand: None", "customer: None"]),
    ("2:0", 2, 3, 0, "", "brand", "hi", "", []),
]


def numbered(spark, path, **options):
    return src.number_threads(src.read_threads(spark, str(path), **options), Workspace(spark, "t"))


def test_one_json_array(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CORPUS, ensure_ascii=False, indent=1), encoding="utf-8")
    flat = src.flatten_threads(numbered(spark, tmp_path / "c.json", multi_line=True))
    assert sorted(tuple(r) for r in flat.collect()) == FLAT


def test_json_lines_over_several_files_and_parquet(spark, tmp_path):
    for name, part in (("b.json", CORPUS[2:]), ("a.json", CORPUS[:2])):
        (tmp_path / name).write_text("\n".join(json.dumps(t) for t in part) + "\n\n", encoding="utf-8")
    threads = numbered(spark, tmp_path)
    assert sorted(tuple(r) for r in src.flatten_threads(threads).collect()) == FLAT
    out = str(tmp_path / "pq")
    threads.drop("thread_idx").coalesce(1).sortWithinPartitions("seed_id").write.parquet(out)
    again = numbered(spark, out, format="parquet")
    assert sorted((r["thread_idx"], r["seed_id"]) for r in again.collect()) == [(0, 3), (1, 9), (2, 9)]


def test_numbers_follow_files_and_splits(spark, tmp_path):
    lines = [json.dumps({"seed_id": i, "messages": []}) for i in range(5000)]
    for f in range(5):
        (tmp_path / f"part-{f}.json").write_text("\n".join(lines[f * 1000 : (f + 1) * 1000]), encoding="utf-8")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "7000")
    try:
        rows = numbered(spark, tmp_path).select("thread_idx", "seed_id").collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 5000 and all(r["thread_idx"] == r["seed_id"] for r in rows)


@pytest.mark.parametrize("bad", ('{"messages": []}', '{"seed_id": 1}', '{"seed_id": 1, "messages": [{"text": "x"}]}', "{oops"))
def test_missing_keys_and_broken_lines_fail(spark, tmp_path, bad):
    (tmp_path / "c.json").write_text(bad, encoding="utf-8")
    with pytest.raises(Exception, match="required key|MALFORMED|FAILED_READ"):
        src.flatten_threads(numbered(spark, tmp_path)).collect()


@pytest.mark.parametrize("size", [7, 256])
def test_long_threads_are_one_thread(spark, tmp_path, size):
    """Threads of 150 and 10,000 turns in records of bounded size read like undivided ones."""
    lengths = {3: 150, 4: 1, 8: 10_000}
    flat = spark.createDataFrame(
        [(f"{c}:{t}", c, c % 90, t, "x", "brand" if t % 3 else "customer", None if t % 7 == 5 else f"turn {t}", f"cust_{c}")
         for c, n in lengths.items() for t in range(n)],
        "id string, thread_idx long, seed_id long, turn_index long, platform string, author string, text string, "
        "customer_name string",
    )
    nested = sample.threads(flat, turns_per_record=size).cache()
    assert nested.select(F.max(F.size("messages"))).first()[0] == size
    got = src.flatten_threads(nested.withColumnRenamed("conv_id", "thread_idx"))
    want = context.with_context(flat).withColumn("text", F.coalesce("text", F.lit("")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))

    sample.write_threads(nested, str(tmp_path / "json"))
    numbered_rows = numbered(spark, tmp_path / "json").groupBy("thread_idx", "seed_id").agg(F.sum(F.size("messages")))
    assert sorted(map(tuple, numbered_rows.collect())) == [(0, 3, 150), (1, 4, 1), (2, 8, 10_000)]


def test_parquet_numbering_stores_no_copy(spark, tmp_path):
    rows = [(i, "", "", []) for i in range(500)]
    schema = "seed_id long, platform string, customer_name string, messages array<struct<`from`:string,text:string>>"
    spark.createDataFrame(rows, schema).repartitionByRange(4, "seed_id").sortWithinPartitions("seed_id").write.parquet(
        str(tmp_path / "pq")
    )
    workspace = Workspace(spark, "t")
    found = src.number_threads(src.read_threads(spark, str(tmp_path / "pq"), format="parquet"), workspace)
    assert all(r.thread_idx == r.seed_id for r in found.collect())
    assert [p.name for p in Path(workspace.path).iterdir()] == ["threads-offsets"]


def test_first_threads(spark, sf_small):
    m = sample.messages(spark, sf_small)
    assert src.first_threads(m, 3).select("thread_idx").distinct().count() == 3
    assert src.first_threads(m, 0).count() == src.first_threads(m, None).count() == m.count()


def test_csv_has_bom_and_reads_back(spark, sf_small, tmp_path):
    labelled = fill_with_standin(local_stages(sample.messages(spark, sf_small), RoutingConfig()))
    nasty = [("9:0", 'a "b", c\nd \\ e'), ("9:1", "  spaces  "), ("9:2", ""), ("9:3", '"'), ("9:4", "عربي\tx"), ("9:5", "\\")]
    output = merge.labels_output(labelled)
    extra = spark.createDataFrame(
        [(i, 9, 9, n, "", "customer", t, "", "", "", "") for n, (i, t) in enumerate(nasty)], output.schema
    )
    output = output.unionByName(extra)
    out = tmp_path / "labels"
    tables.write_csv(output, str(out))
    want = sorted(tuple(str(c) for c in r) for r in output.collect())
    got = []
    for part in out.glob("*.csv"):
        assert part.read_bytes().startswith(b"\xef\xbb\xbf")
        with part.open(encoding="utf-8-sig", newline="") as f:
            rows = list(csv.reader(f))
        assert tuple(rows[0]) == merge.OUTPUT_COLUMNS
        got += [tuple(r) for r in rows[1:]]
    assert sorted(got) == want
    back = tables.read_csv(spark, str(out), output.schema)
    assert sorted(tuple(str(c) for c in r) for r in back.collect()) == want


def test_csv_single_file(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS thread_idx", "id % 3 AS turn_index", "'é' AS text").repartition(7)
    tables.write_csv(df, str(tmp_path / "one"), single_file=True)
    (part,) = (tmp_path / "one").glob("*.csv")
    rows = list(csv.reader(part.open(encoding="utf-8-sig", newline="")))
    assert [int(r[0]) for r in rows[1:]] == list(range(100))


def test_result_log_skips_damage(spark, tmp_path):
    good = {"id": "0:0", "thread_idx": 0, "seed_id": 1, "turn_index": 0, "platform": "x", "frm": "customer",
            "label": "spam", "confidence": "high", "source": "api", "reason": "api_classified", "batch": 4}
    text = json.dumps(good) + "\n\n   \nnot json\n" + json.dumps({**good, "id": "0:1"})[:-9] + "\n" + json.dumps({**good, "id": "0:2"})
    (tmp_path / "log.jsonl").write_text(text, encoding="utf-8")
    rows = result_log.read_json_log(spark, str(tmp_path / "log.jsonl")).collect()
    assert sorted(r["id"] for r in rows) == ["0:0", "0:2"] and rows[0]["batch"] == 4


def test_missing_logs_are_empty(spark, tmp_path):
    assert result_log.read_json_log(spark, str(tmp_path / "none.jsonl")).count() == 0
    assert result_log.read_log(spark, str(tmp_path / "none")).count() == 0


def test_workspace_is_below_the_shared_folder(spark):
    w = Workspace(spark, "t")
    assert w.path.startswith(shared_folder(spark)) and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    w.save(spark.range(3), "x")
    assert Path(w.folder("x")).exists()
    w.drop()
    assert not Path(w.path).exists()


def test_rejected_lines_have_a_place_and_a_reason(spark, tmp_path):
    log = tmp_path / "log"
    assert result_log.read_json_log_rejects(spark, str(log)).isEmpty()
    log.mkdir()
    good = '{"id": "1:0", "thread_idx": 1, "turn_index": 0, "label": "spam", "batch": null, "more": [1]}'
    bad = {
        '{"id": "1:1", "label": "sp': "cut off",
        '{"id": "1:2", "batch": "x", "seed_id": {"a": 1}, "label": 5}': "wrong type: seed_id, batch",
        '{"id" "1:3"}': "not JSON",
        "plain text": "not an object",
        "7": "not an object",
        '"{"': "not an object",
    }
    for n, lines in enumerate((list(bad)[:3], list(bad)[3:])):
        (log / f"part-{n}.json").write_text("\n".join([good, *lines, "", "   ", good]), encoding="utf-8")
    found = {r.line: (Path(r.file).name, r.reason) for r in result_log.read_json_log_rejects(spark, str(log)).collect()}
    want = {line: (f"part-{n // 3}.json", reason) for n, (line, reason) in enumerate(bad.items())}
    assert found == want
    assert len(result_log.read_json_log(spark, str(log)).collect()) == 4


def test_a_pair_is_published_as_one(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    table = lambda n: spark.createDataFrame([(n, 0)], "thread_idx long, turn_index long")

    def pair():
        folder = tables.current_outputs(spark, out)
        return folder and [spark.read.parquet(f"{folder}/{t}").first()[0] for t in ("labels", "thread_summary")]

    class Lost(Exception):
        pass

    real = tables.in_corpus_order

    def dies_at(call):
        calls = iter(range(9))

        def sort(df):
            if next(calls) == call:
                raise Lost
            return real(df)

        return sort

    assert pair() is None
    for n, before in ((1, None), (2, [1, 1])):
        for call in (0, 1):
            with monkeypatch.context() as broken:
                broken.setattr(tables, "in_corpus_order", dies_at(call))
                with pytest.raises(Lost):
                    tables.publish_outputs(table(9), table(9), out)
            assert pair() == before
        tables.publish_outputs(table(n), table(n), out)
        assert pair() == [n, n]
    tables.drop_older_outputs(spark, out)
    assert pair() == [2, 2] and len(list(Path(out).glob("version=*"))) == 1
