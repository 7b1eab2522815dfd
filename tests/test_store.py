"""Work folders, their removal, and the refusal of a machine's own folder on a cluster."""

import os
import time
from types import SimpleNamespace

import pytest

from driftline.core import scan, store


def test_a_cluster_without_a_shared_folder_is_refused():
    conf = SimpleNamespace(get=lambda *a: None)
    for master, fine in (("local", True), ("local[4]", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://h:7077", False), ("k8s://x", False)):
        context = SimpleNamespace(master=master, applicationId="app-test", getConf=lambda: conf)
        session = SimpleNamespace(conf=conf, sparkContext=context)
        if fine:
            assert store.base_dir(session).startswith("file://")
        else:
            with pytest.raises(ValueError):
                store.base_dir(session)


def test_work_lies_below_the_application_and_old_work_is_swept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "base_dir", lambda s: f"file://{tmp_path}")
    df = store.cut(spark.range(5), "five")
    assert df.count() == 5 and os.listdir(f"{tmp_path}/driftline") == [spark.sparkContext.applicationId]
    old = f"{tmp_path}/driftline/app-old/x"
    os.makedirs(old)
    assert store.sweep(spark) == []
    past = time.time() - 30 * 86_400
    for p in (old, os.path.dirname(old)):
        os.utime(p, (past, past))
    assert store.sweep(spark) == ["app-old"] and df.count() == 5


def test_small_lists_are_sent_around_and_long_ones_joined(spark, monkeypatch):
    monkeypatch.setattr(scan, "SMALL_ROWS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(10)
        plan = lambda n: big.join(scan.small(store.cut(spark.range(n), "s")), "id")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(3) and "BroadcastHashJoin" not in plan(4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
