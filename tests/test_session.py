"""The shared folder, in sessions of their own."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from ledgerloom.session import scratch_folder, shared_folder
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if {folder!r}:
    builder = builder.config("spark.checkpoint.dir", {folder!r})
spark = builder.getOrCreate()
try:
    print("FOLDER", shared_folder(spark))
    scratch = scratch_folder(spark)
    spark.range(3).write.parquet(scratch + "/rows")
    print("SCRATCH", scratch, os.path.isdir(scratch))
except RuntimeError as error:
    print("REFUSED", error)
"""


def run(tmp_path, folder: str) -> dict[str, str]:
    root = str(Path(__file__).resolve().parents[1])
    script = SCRIPT.format(root=root, folder=folder)
    # an empty configuration folder, so that no checkpoint folder comes from the machine's own settings
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180, env=environment)
    said = dict(line.split(" ", 1) for line in done.stdout.splitlines() if " " in line)
    assert said, done.stderr[-2000:]
    return said


def test_shared_folder_is_the_configured_one_and_scratch_goes_with_the_process(tmp_path):
    folder = str(tmp_path / "shared")
    said = run(tmp_path, folder)
    assert said["FOLDER"] == folder
    scratch, existed = said["SCRATCH"].rsplit(" ", 1)
    assert existed == "True" and scratch.startswith(f"{folder}/ledgerloom-") and not os.path.exists(scratch)


def test_no_shared_folder_is_refused(tmp_path):
    assert "spark.checkpoint.dir" in run(tmp_path, "")["REFUSED"]
