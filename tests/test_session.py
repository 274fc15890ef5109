"""Shared scratch root: read from the session, never invented on a cluster."""

import pytest

from martline.session import app_id, scratch_path, shared_root


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _NoContext:
    """A session without a SparkContext (as with Spark Connect)."""

    def __init__(self, conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(ValueError):
        shared_root(_NoContext({"spark.master": "yarn"}))


def test_configured_checkpoint_dir_is_used():
    s = _NoContext({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_root(s) == "hdfs://nn/shared/ckpt"
    a, b = scratch_path(s, "x"), scratch_path(s, "x")
    assert a.startswith("hdfs://nn/shared/ckpt/martline/x/") and a != b


def test_app_id_without_context():
    assert app_id(_NoContext({"spark.app.id": "app-1"})) == "app-1"


def test_session_root_matches_its_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
