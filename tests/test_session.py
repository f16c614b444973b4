"""The shared folder: named, local only on one machine, and cleaned up."""

import os
from types import SimpleNamespace

import pytest

from shoplens import session


def fake(master, conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(session.NoSharedFolder):
        session.shared_dir(fake(master, {}))
    assert session.shared_dir(fake(master, {"spark.checkpoint.dir": "hdfs:///c"})) == "hdfs:///c"


def test_one_machine_gets_a_local_folder():
    assert os.path.isdir(session.shared_dir(fake("local[2]", {})))


def test_scratch_is_dropped(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    other = os.path.dirname(path.removeprefix("file:"))
    assert os.path.isdir(other)
    # on a copy of the setting, as other tests still read this session's scratch tables
    held = session._scratch_root
    session._scratch_root = lambda s: path
    try:
        session.drop_scratch(spark)
    finally:
        session._scratch_root = held
    assert not os.path.exists(path.removeprefix("file:")) and os.path.isdir(other)
