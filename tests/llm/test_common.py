from types import SimpleNamespace

import pytest

from colwarden.llm import common


def session(master, folder=None):
    unset = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: unset))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    assert common.shared_root(session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    for master in ("spark://host:7077", "yarn", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.shared_root(session(master))


def test_fresh_names_clash_with_none(spark):
    df = spark.createDataFrame([(1, 2)], "Size int, _size int")
    assert common.fresh(df, "size", "size", "other") == ["__size", "___size", "other"]
