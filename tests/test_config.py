"""The shared folder comes from the session; a bare session gets a registered fallback."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert not s.conf.get("spark.checkpoint.dir", None)
from tonetide.config import cut_lineage, scratch_path, shared_dir
assert shared_dir(s) and scratch_path(s, "x").startswith(shared_dir(s))
assert cut_lineage(s.range(7)).count() == 7
print("OK")
""" % ROOT


def test_fallback_when_checkpoint_dir_unset():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="tonetide-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-2000:]


def test_session_setting_is_used(spark):
    from tonetide.config import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == configured.rstrip("/")


def test_scratch_is_cleaned(spark):
    from tonetide.config import clean_scratch, scratch_path

    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(local) and clean_scratch(spark) >= 1 and not os.path.exists(local)
    assert clean_scratch(spark) == 0


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from tonetide.config import shared_dir

    nothing = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=nothing, sparkContext=context))
