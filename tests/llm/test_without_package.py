"""The corpus queries where only the driver has the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tillmart.llm.queries import QUERIES

REPO = str(Path(__file__).parents[2])
FOLDER = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", {scratch!r})
    .getOrCreate()
)
found = spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("tillmart") is None).collect()
assert found == [True], "workers see the package"
for key in {keys!r}:
    frame = __spark_entry__.queries()[key](spark, {folder!r})
    assert frame.count() > 0, key
print("all done")
"""


@pytest.mark.parametrize("keys", [sorted(QUERIES), ["pipeline"]], ids=["queries", "pipeline"])
def test_workers_need_no_package(tmp_path, keys):
    """Workers start in another folder, without the repository on their path."""
    script = SCRIPT.format(repo=REPO, scratch=str(tmp_path / "scratch"), keys=keys, folder=FOLDER)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900
    )
    assert run.returncode == 0 and "all done" in run.stdout, run.stderr[-3000:]
