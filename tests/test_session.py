from __future__ import annotations

import types

import pytest

from tarn import session


def fake(master, folder=None):
    context = types.SimpleNamespace(master=master, applicationId=f"app-{master}")
    conf = types.SimpleNamespace(get=lambda key, default: folder or default)
    return types.SimpleNamespace(sparkContext=context, conf=conf)


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(fake("yarn", "hdfs://nn/ck/")) == "hdfs://nn/ck"
    assert session.scratch(fake("yarn", "hdfs://nn/ck"), "x").startswith("hdfs://nn/ck/x-")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn"))


def test_local_session_gets_one_folder():
    local = fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_cut_lineage(spark):
    df = session.cut_lineage(spark.range(5).selectExpr("id * 2 AS v"))
    assert sorted(r["v"] for r in df.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in df._jdf.queryExecution().analyzed().toString()
