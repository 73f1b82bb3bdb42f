"""Session rules: where intermediate tables may go."""

import pytest

from quire import session


class _Cluster:
    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_no_temp_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster)


def test_checkpoint_folder_is_the_sessions_own(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
