"""Shared-folder resolution without a running cluster setting."""

from __future__ import annotations

import os

import pytest

from oddsframe import session
from oddsframe.session import checkpoint_root, scratch_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.dir, self.master = None, master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, values, master="local[2]"):
        self.conf = _Conf(values)
        self.sparkContext = _Context(master)


@pytest.fixture(autouse=True)
def removed(monkeypatch):
    """The folders that are to be removed when the JVM ends."""
    listed = []
    monkeypatch.setattr(session, "remove_at_exit", lambda spark, path: listed.append(path))
    return listed


def test_uses_the_cluster_folder_when_named(removed):
    s = _Session({"spark.checkpoint.dir": "hdfs://shared/ckpt"}, "yarn")
    assert checkpoint_root(s) == "hdfs://shared/ckpt"
    assert scratch_dir(s, "x").startswith("hdfs://shared/ckpt/oddsframe-x-")
    assert s.sparkContext.dir is None      # nothing registered when already named
    assert len(removed) == 1


def test_registers_a_private_folder_on_one_machine_only():
    s = _Session({})
    first = checkpoint_root(s)
    assert os.path.isdir(first) and s.sparkContext.dir == first
    assert checkpoint_root(s) == first     # reused, not a new folder each call
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(_Session({}, master))


def test_scratch_dir_keeps_uri_roots():
    s = _Session({"spark.checkpoint.dir": "file:/tmp/ck/"})
    assert scratch_dir(s, "y").startswith("file:/tmp/ck/oddsframe-y-")
    s3 = _Session({"spark.checkpoint.dir": "s3a://bucket/ck"})
    assert scratch_dir(s3, "z").startswith("s3a://bucket/ck/oddsframe-z-")
