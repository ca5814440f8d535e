"""The shared checkpoint folder comes from the session."""

from ledgermatch.session import checkpoint_root, scratch_path


def test_checkpoint_folder_is_the_sessions(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured   # set by the test session, as a cluster's configuration would
    assert checkpoint_root(spark) == configured.rstrip("/")
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_scratch_folders_are_unique_and_below_it(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark) + "/") and b.startswith(checkpoint_root(spark) + "/")


def test_cluster_session_without_shared_folder_is_refused():
    import pytest

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
