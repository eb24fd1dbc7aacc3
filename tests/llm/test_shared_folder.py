"""Where intermediate tables go with and without spark.checkpoint.dir."""

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from viewloom.llm.common import scratch, shared_folder

REPO = Path(__file__).resolve().parents[2]

CODE = """
from pyspark.sql import SparkSession
from viewloom.llm.common import QUERIES, shared_folder
import viewloom.llm
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
folder = shared_folder(spark)
assert folder == shared_folder(spark) and folder.startswith("file:")
rows = QUERIES["op3_url_rules"](spark, "/root/testdata/sf0.001").count()
assert rows == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
print("all well")
"""


def test_a_session_without_the_setting(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": f"{REPO}:{os.environ.get('PYTHONPATH', '')}"}
    done = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=240)
    assert "all well" in done.stdout, done.stderr[-2000:]


def test_a_cluster_without_the_setting_is_an_error():
    unset = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    context = SimpleNamespace(master="local-cluster[2,1,1024]", _jsc=SimpleNamespace(sc=lambda: unset))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_each_call_has_a_folder_of_its_own(spark):
    assert scratch(spark) != scratch(spark) and scratch(spark).startswith(shared_folder(spark).rstrip("/"))
