import pytest

from tidemark import session


class Conf(dict):
    def set(self, k, v):
        self[k] = v


class Remote:
    """A session that is not local, as far as its settings tell."""

    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", ""])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Remote(spark_master=master))


def test_a_configured_folder_is_used_as_it_is():
    remote = Remote(spark_master="yarn")
    remote.conf["spark.checkpoint.dir"] = "hdfs://nn/shared/"
    assert session.shared_dir(remote) == "hdfs://nn/shared"
    assert session.scratch_path(remote, "x").startswith("hdfs://nn/shared/tidemark/x-")


def test_scratch_paths_are_removed(spark):
    saved, session._SCRATCH[:] = session._SCRATCH[:], []
    try:
        path = session.scratch_path(spark, "test-clear")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
        assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
        with pytest.raises(Exception):
            spark.read.parquet(path).count()
    finally:
        session._SCRATCH[:] = saved
