"""The shared folder: named by the session, or chosen by a local master only."""

from types import SimpleNamespace

import pytest

from rawfold.session import shared_dir


def fake(master, folder=None):
    context = SimpleNamespace(master=master, getConf=lambda: {}, setCheckpointDir=lambda d: None)
    conf = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_the_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake(master))
    assert shared_dir(fake(master, "hdfs:///scratch")) == "hdfs:///scratch"


def test_a_local_session_may_leave_it_unset():
    s = fake("local[4]")
    assert shared_dir(s) == shared_dir(s)
