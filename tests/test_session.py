"""Session helpers: the checkpoint folder comes from the session; cluster sizing."""

import pytest

from shelfrank.plans import session


def test_checkpoint_dir_from_session(spark):
    d = session.checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_only_one_process_sessions_make_a_folder(monkeypatch):
    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, master, setting=None):
            self.sparkContext = Context(master)
            self.conf = {"spark.checkpoint.dir": setting} if setting else {}

    for master in ("local", "local[4]", "local[*]"):
        assert "shelfrank-ckpt-" in session.checkpoint_dir(Session(master))
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077"):
        assert session.checkpoint_dir(Session(master, "hdfs:///shared")) == "hdfs:///shared"
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(Session(master))


def test_cluster_settings_scale_with_input():
    small = session.cluster_settings(1e9, executors=2, cores_per_executor=4)
    big = session.cluster_settings(100e12, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24          # at least 3 waves of 8 slots
    assert int(big["spark.sql.shuffle.partitions"]) > 300_000         # about 256 MB per partition
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
