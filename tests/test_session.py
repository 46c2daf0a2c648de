"""The shared folder: which one each kind of session gets."""

import pytest

from starloom import session


class Context:
    """What ``shared_root`` asks a SparkContext."""

    def __init__(self, master, conf, directory=None):
        self.master, self.conf, self.directory = master, conf, directory

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, directory):
        self.directory = directory


class Session:
    def __init__(self, master, directory=None, **conf):
        self.conf = {"spark.sql.warehouse.dir": "hdfs://store/warehouse/", **conf}
        self.sparkContext = Context(master, self.conf, directory)


CLUSTERS = ["spark://host:7077", "yarn", "k8s://host", "local-cluster[3,2,1024]"]


@pytest.mark.parametrize("master", [*CLUSTERS, "local[2]"])
@pytest.mark.parametrize("folder", ["/mnt/shared/", "file:/mnt/shared", "file:///mnt/shared", "hdfs://store/shared"])
def test_the_configured_folder_is_taken_as_it_is(master, folder):
    spark = Session(master, **{"spark.checkpoint.dir": folder})
    assert session.shared_root(spark) == folder.rstrip("/")
    assert spark.sparkContext.directory == folder


@pytest.mark.parametrize("master", CLUSTERS)
def test_a_cluster_without_that_setting_uses_what_its_executors_share(master):
    assert session.shared_root(Session(master, "hdfs://store/set/1")) == "hdfs://store/set/1"
    spark = Session(master)
    assert session.shared_root(spark) == "hdfs://store/warehouse/starloom-checkpoints" == spark.sparkContext.directory
    assert session.scratch_path(spark, "t").startswith("hdfs://store/warehouse/starloom-checkpoints/starloom-work/t-")


def test_a_local_session_keeps_its_private_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_LOCAL_ROOT", str(tmp_path))
    for master in ("local", "local[4]", "local[*]"):
        assert session.shared_root(Session(master)) == str(tmp_path)
