import os

import pytest

from tablekit import session
from tablekit.session import ensure_checkpoint_dir, remove_dir, shared_dir


def test_checkpoint_dir_comes_from_session_conf(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = ensure_checkpoint_dir(spark)
    assert got.replace("file:", "").startswith(configured.replace("file:", ""))
    # A second call keeps the same folder.
    assert ensure_checkpoint_dir(spark) == got


def test_shared_dirs_are_fresh_and_under_checkpoint(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert a.replace("file:", "").startswith(base)
    spark.range(3).write.parquet(a)
    assert os.path.isdir(a.replace("file:", ""))
    assert remove_dir(spark, a) and not os.path.exists(a.replace("file:", ""))
    assert not remove_dir(spark, a)


class _Context:
    """The parts of a SparkContext that the folder lookup reads."""

    def __init__(self, master):
        self.master, self.path = master, None

    def getCheckpointDir(self):
        return self.path

    def setCheckpointDir(self, path):
        self.path = path

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


def test_unset_folder_is_an_error_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(master))
    for master in ("local", "local[4]", "local[*]"):
        assert "tablekit-ckpt-" in session.ensure_checkpoint_dir(_Session(master))
