"""Checkpoint-folder resolution: the session's setting first, a scratch
folder only when it is unset."""

from __future__ import annotations

import os

from touchline.session import checkpoint_dir


class _Opt:
    def __init__(self, value=None):
        self.value = value

    def isDefined(self):
        return self.value is not None

    def get(self):
        return self.value


class _FakeSC:
    def __init__(self, master="local[2]"):
        self.master = master
        self.dir = None
        outer = self

        class _Jsc:
            def sc(self):
                class _Sc:
                    def getCheckpointDir(self):
                        return _Opt(outer.dir)

                return _Sc()

        self._jsc = _Jsc()

    def setCheckpointDir(self, path):
        self.dir = path + "/uuid-subdir"


class _FakeSpark:
    def __init__(self, configured=None, master="local[2]"):
        self.configured = configured
        self.sparkContext = _FakeSC(master)

        class _Conf:
            def get(_self, key, default=None):
                return self.configured if key == "spark.checkpoint.dir" else default

        self.conf = _Conf()


def test_configured_folder_is_used_as_is():
    assert checkpoint_dir(_FakeSpark("hdfs://shared/ckpt")) == "hdfs://shared/ckpt"


def test_unset_folder_gets_one_scratch_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    spark = _FakeSpark(None)
    first = checkpoint_dir(spark)
    assert first.startswith(str(tmp_path)) and os.path.isdir(first.rsplit("/", 1)[0])
    assert checkpoint_dir(spark) == first  # reused, not a new folder per call


def test_cluster_without_setting_is_an_error():
    import pytest

    with pytest.raises(RuntimeError, match="shared storage"):
        checkpoint_dir(_FakeSpark(None, master="yarn"))
    assert checkpoint_dir(_FakeSpark("s3a://bucket/ckpt", master="yarn")) == "s3a://bucket/ckpt"


def test_real_session_reads_its_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert checkpoint_dir(spark) == configured
    else:
        assert checkpoint_dir(spark)
