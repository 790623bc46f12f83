"""Checkpoint directory rules: configured dir wins; no local fallback on a cluster."""

import pytest

from courtside.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self._dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"


def test_local_session_gets_a_scratch_dir():
    s = _Session("local[4]")
    assert ensure_checkpoint_dir(s).startswith("/")


def test_real_session_has_a_checkpoint_dir(spark):
    assert spark.sparkContext.getCheckpointDir()
