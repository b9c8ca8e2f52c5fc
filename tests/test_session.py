import pytest

from ledgerline.session import shared_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    """Just enough of a session for ``shared_root``: a conf and no SparkContext."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_cluster_session_without_checkpoint_dir_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session({"spark.master": "yarn"}))


def test_configured_checkpoint_dir_is_used():
    s = _Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert shared_root(s) == "hdfs:///shared/ckpt"


def test_local_session_gets_its_own_folder(spark):
    root = shared_root(spark)
    assert root and shared_root(spark) == root
