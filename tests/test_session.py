import os
import subprocess
import sys

import pytest

from chronoframe import session


def _run(code: str, **env: str) -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_submitted_master_and_partitions_are_kept():
    out = _run(
        "from chronoframe.session import get_spark; s = get_spark(); "
        "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))",
        PYSPARK_SUBMIT_ARGS="--master local[3] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell",
    )
    assert out.split() == ["local[3]", "77"]


def test_scratch_needs_a_shared_folder_off_the_local_master(monkeypatch, spark):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_scratch_tables_can_be_dropped(spark):
    kept = session.materialize(spark.range(5), "kept")
    assert kept.count() == 5
    path = session.scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    assert os.listdir(path)
    session.drop_scratch(spark)
    assert not os.path.exists(path)
