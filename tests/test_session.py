"""Checkpoint-folder rules: read the cluster's setting; a temp folder only locally."""

from __future__ import annotations

import pytest

from snapmart.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = conf
        self.dir = None

    def getCheckpointDir(self):  # noqa: N802 - mirrors the Spark API
        return self.dir

    def getConf(self):  # noqa: N802
        return _Conf(self._conf)

    def setCheckpointDir(self, path):  # noqa: N802
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_setting_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_setting_is_used():
    session = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(session) == "hdfs:///shared/ckpt"


def test_local_without_setting_gets_a_temp_folder():
    path = ensure_checkpoint_dir(_Session("local[2]"))
    assert path and "snapmart-ckpt-" in path


def test_scratch_run_leaves_no_folder(spark):
    import glob

    import __spark_entry__ as entry_module
    from snapmart.session import checkpoint_root, scratch_run
    from tests.conftest import SF_SMALL

    root = checkpoint_root(spark).removeprefix("file:") + "/snapmart-scratch/*"
    before = set(glob.glob(root))
    with scratch_run():
        assert entry_module.queries()["momentum_ranking"](spark, SF_SMALL).count() > 0
        assert set(glob.glob(root)) - before
    assert set(glob.glob(root)) <= before
