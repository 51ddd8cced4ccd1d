"""Readers and writers on small files."""

import json

from pyspark.sql import functions as F

from taskcurate.operators import trajectories
from taskcurate.sources import readers as R
from taskcurate.sources import writers as W


def test_array_and_map_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}], indent=1))
    (tmp_path / "m.json").write_text(json.dumps({"x": {"k": 1}, "y": {"k": 2}}, indent=1))
    assert sorted(r.k for r in R.read_json_array(spark, str(tmp_path / "a.json"), "k int").collect()) == [1, 2]
    assert {(r.instance_id, r.k) for r in R.read_json_map(spark, str(tmp_path / "m.json"), "k:int").collect()} == {("x", 1), ("y", 2)}


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\nnot json\n{"k": 2}\n{"k": ')
    assert sorted(r.k for r in R.read_jsonl_tolerant(spark, str(tmp_path / "*.jsonl"), "k int").collect()) == [1, 2]


def test_pick_instances_file(spark, tmp_path):
    for n in ("z_instances.jsonl", "a_instances_failures.jsonl", "b_instances_versions.jsonl", "q_instances_subset.jsonl"):
        (tmp_path / n).write_text("{}\n")
    assert R.pick_instances_file(spark, str(tmp_path)).endswith("q_instances_subset.jsonl")


def test_instance_folders(spark, tmp_path):
    for i in ("o__r-1", "o__r-2"):
        (tmp_path / i).mkdir()
        (tmp_path / i / "status.json").write_text(json.dumps({"status": "ok", "n": len(i)}, indent=2))
        (tmp_path / i / "log.txt").write_text("a\nb\n")
    rows = R.read_instance_folders(spark, str(tmp_path), "status.json", "status string, n int").collect()
    assert {(r.instance_id, r.status, r.n) for r in rows} == {("o__r-1", "ok", 6), ("o__r-2", "ok", 6)}
    assert {r.text for r in R.read_instance_folders(spark, str(tmp_path), "log.txt").collect()} == {"a\nb\n"}


def test_first_commits_by_name(spark, tmp_path):
    for n in ("b", "a", "c"):
        (tmp_path / f"{n}.json").write_text(json.dumps({"new_commit_hash": n, "file_diffs": []}, indent=1))
    assert [r.new_commit_hash for r in R.read_commits(spark, str(tmp_path), first=2).collect()] == ["a", "b"]


def test_trajectories_and_lists(spark, tmp_path):
    row = {"docker_image": "x.y", "reward": 1.0, "trajectory_steps": [{"thought": "t", "action": "a"}, {"thought": "u", "action": "b"}]}
    (tmp_path / "t.jsonl").write_text(json.dumps(row) + "\n")
    runs = R.read_jsonl(spark, str(tmp_path / "t.jsonl"), R.TRAJECTORY)
    assert [(r.step_idx, r.thought) for r in R.trajectory_steps(runs, ["docker_image"]).collect()] == [(0, "t"), (1, "u")]
    df = spark.createDataFrame([('["a"]', None)], "FAIL_TO_PASS string, PASS_TO_PASS string")
    assert tuple(R.benchmark_lists(df).first()) == (["a"], [])


def test_replace_manifest_split_and_sheet(spark, tmp_path):
    df = spark.range(5).withColumn("verdict", F.when(F.col("id") < 2, "KEEP").otherwise("REJECT"))
    assert W.write_replacing(df, str(tmp_path / "o"), str(tmp_path / "m")) == 5
    assert W.write_replacing(df.limit(3), str(tmp_path / "o"), str(tmp_path / "m")) == 3
    assert spark.read.json(str(tmp_path / "o")).count() == 3 and spark.read.json(str(tmp_path / "m")).count() == 2
    W.write_split(df, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s" / "_split=KEEP")).count() == 2
    sheet = spark.createDataFrame([("i1", ["a"], "x\\ny", None)], "instance_id string, FAIL_TO_PASS array<string>, hints_text string, resolved boolean")
    W.write_review_sheet(sheet, str(tmp_path / "x"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "x")).first()
    assert len(back) == 23 and back.FAIL_TO_PASS == '["a"]' and back.hints_text == "x\ny"


def test_training_export(spark, tmp_path):
    heads = spark.createDataFrame([(1, ["h"], None), (0, ["g"], ["t"]), (1, None, None)], "reward int, history array<string>, tools array<string>")
    W.write_training(trajectories.training_rows(heads, "history", "tools"), str(tmp_path / "all"), str(tmp_path / "one"))
    assert spark.read.text(str(tmp_path / "all")).count() == 2
    assert [r.value for r in spark.read.text(str(tmp_path / "one")).collect()] == ['["h"]']


def test_scratch_uses_the_shared_folder():
    from types import SimpleNamespace

    from taskcurate.sources.scratch import scratch_path

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs://shared/x/"}.get(key, default)))
    assert scratch_path(cluster, "n").startswith("hdfs://shared/x/n-")


def test_a_failed_job_leaves_the_old_output(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from taskcurate.sources import writers

    path = str(tmp_path / "out")
    writers.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="no good"):
        writers.write_table(spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no good"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    writers.write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not list(tmp_path.glob("out.replaced*"))


def test_old_output_that_was_moved_aside_comes_back(spark, tmp_path):
    from taskcurate.sources import scratch

    spark.range(2).write.parquet(str(tmp_path / "out.replaced"))  # a job that ended between its two moves
    spark.range(4).write.parquet(str(tmp_path / "new"))
    scratch.put_in_place(spark, str(tmp_path / "new"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_first_commits_by_name_open_no_other_file(spark, tmp_path):
    import json

    from taskcurate.sources import readers

    for i in range(6):
        (tmp_path / f"c{i}.json").write_text(json.dumps({"new_commit_hash": f"h{i}"}) if i < 3 else "not json at all {")
    df = readers.read_commits(spark, str(tmp_path), 3)
    assert sorted((r.new_commit_hash, r.file_name) for r in df.collect()) == [(f"h{i}", f"c{i}.json") for i in range(3)]
    assert len(df.inputFiles()) == 3
    assert readers.read_commits(spark, str(tmp_path), 0).count() == 0


def test_nested_commits_are_stored_compressed(spark, monkeypatch, tmp_path):
    from taskcurate.catalog import io_checks
    from taskcurate.catalog.views import Views

    from .conftest import SF_DIR

    monkeypatch.setattr(io_checks, "_path", lambda v, name: str(tmp_path / name))
    rows = io_checks.nested_commits(Views(spark, SF_DIR)).count()
    files = list((tmp_path / "s10").glob("part-*"))
    assert rows and files and all(f.suffix == ".gz" for f in files)
