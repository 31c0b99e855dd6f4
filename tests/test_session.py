from __future__ import annotations

from types import SimpleNamespace

import pytest

from dayledger.session import CHECKPOINT_DIR, scratch_path, scratch_root, sibling_session


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)))


def test_the_shared_folder_of_the_session_is_used():
    cluster = session("yarn", **{CHECKPOINT_DIR: "hdfs://nn/shared/"})
    assert scratch_root(cluster) == "hdfs://nn/shared"
    first, second = (scratch_path(cluster, "x") for _ in range(2))
    assert first.startswith("hdfs://nn/shared/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        scratch_root(session("yarn"))


def test_a_local_session_gets_one_temp_folder():
    assert scratch_root(session("local[4]")) == scratch_root(session("local[4]"))


def test_a_sibling_keeps_the_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        other = sibling_session(spark)
        assert other.conf.get("spark.sql.shuffle.partitions") == "5"
        assert other.conf.get("spark.sql.session.timeZone") == "UTC"
        assert other.sparkContext is spark.sparkContext
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
