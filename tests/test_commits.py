"""One commit for several tables: cut-off runs, replays, conflicts, versions."""

import pytest
from pyspark.sql import types as T

from tidewater.sinks import commits

A = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())])
B = T.StructType([T.StructField("n", T.LongType())])
SCHEMAS = {"a": A, "b": B}


def frames(spark, k):
    return {"a": spark.createDataFrame([(k, f"name {k}")], A), "b": spark.createDataFrame([(k,)], B)}


def rows(spark, root, table, version=None):
    return sorted(tuple(r) for r in commits.read(spark, root, table, SCHEMAS[table], version).collect())


def test_versions_and_replaced_tables(spark, tmp_path):
    root = str(tmp_path)
    assert commits.latest(spark, root) == -1 and rows(spark, root, "a") == []
    assert commits.commit(spark, root, "r0", frames(spark, 0), schemas=SCHEMAS) == 0
    one = frames(spark, 1)
    assert commits.commit(spark, root, "r1", {"a": one["a"]}, {"b": one["b"]}, SCHEMAS) == 1
    assert rows(spark, root, "a") == [(0, "name 0"), (1, "name 1")] and rows(spark, root, "b") == [(1,)]
    assert rows(spark, root, "a", 0) == [(0, "name 0")] and rows(spark, root, "b", 0) == [(0,)]


@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_run_cut_off_leaves_nothing(spark, tmp_path, monkeypatch, after):
    root = str(tmp_path)
    commits.commit(spark, root, "r0", frames(spark, 0), schemas=SCHEMAS)
    real, done = commits.stage, []

    def dies(*args):
        if len(done) == after:
            raise OSError("executor lost")
        done.append(args)
        return real(*args)

    def lost(*args):
        raise OSError("driver lost")
    monkeypatch.setattr(commits, "stage", dies)
    if after == 2:
        monkeypatch.setattr(commits, "publish", lost)
    with pytest.raises(OSError):
        commits.commit(spark, root, "r1", frames(spark, 1), schemas=SCHEMAS)
    monkeypatch.undo()
    assert rows(spark, root, "a") == [(0, "name 0")] and rows(spark, root, "b") == [(0,)]
    assert commits.commit(spark, root, "r1", frames(spark, 1), schemas=SCHEMAS) == 1
    assert rows(spark, root, "a") == [(0, "name 0"), (1, "name 1")] and rows(spark, root, "b") == [(0,), (1,)]


def test_a_run_commits_once(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        assert commits.commit(spark, root, "r0", frames(spark, 0), schemas=SCHEMAS) == 0
    assert rows(spark, root, "a") == [(0, "name 0")]


def test_of_two_runs_from_one_version_one_loses(spark, tmp_path):
    root = str(tmp_path)
    commits.commit(spark, root, "r0", frames(spark, 0), schemas=SCHEMAS)
    commits.commit(spark, root, "r1", frames(spark, 1), schemas=SCHEMAS, base=0)
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, root, "r2", frames(spark, 2), schemas=SCHEMAS, base=0)
    assert rows(spark, root, "a") == [(0, "name 0"), (1, "name 1")]
    assert commits.commit(spark, root, "r2", frames(spark, 2), schemas=SCHEMAS) == 2


def test_a_missing_required_column_is_an_error_before_anything_is_visible(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        commits.commit(spark, root, "r0", {"a": spark.createDataFrame([("x",)], "name string")}, schemas=SCHEMAS)
    assert commits.latest(spark, root) == -1


def test_vacuum_deletes_what_no_manifest_names(spark, tmp_path):
    root = str(tmp_path)
    assert commits.vacuum(spark, root) == []
    commits.commit(spark, root, "r0", frames(spark, 0), schemas=SCHEMAS)
    lost = commits.stage(frames(spark, 1)["a"], root, "a", A)
    assert commits.vacuum(spark, root) == []
    assert commits.vacuum(spark, root, older_than_seconds=-60) == [lost]
    assert rows(spark, root, "a") == [(0, "name 0")] and rows(spark, root, "b") == [(0,)]
