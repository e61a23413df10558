"""Operators whose workers have pyspark, numpy and pyarrow, but not this package on their path."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
seen = spark.range(1).repartition(1).mapInPandas(
    lambda it: (f.assign(id=int(__import__("importlib.util").util.find_spec("sonomere") is not None)) for f in it), "id long")
assert seen.first().id == 0
for name in {names!r}:
    rows = contract.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert rows > 0, name
    print("ran", name, rows)
"""
NAMES = [
    "op1_decontamination", "op2_repair_token_files", "op5_crf_language_id", "op6_segment_tree_bpe",
    "op7_line_crf_quality", "op10_token_counts", "op11_warc", "op12_merkle_manifest", "op13_periodic_runs",
]


def test_workers_without_the_package(tmp_path):
    path = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and Path(p).resolve() != REPO]
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=str(REPO), names=NAMES)], cwd=tmp_path, timeout=600,
        env={**os.environ, "PYTHONPATH": ":".join(path)}, capture_output=True, text=True,
    )
    if run.returncode:
        pytest.fail(run.stdout + run.stderr[-3000:])
    assert run.stdout.count("ran op") == len(NAMES)
