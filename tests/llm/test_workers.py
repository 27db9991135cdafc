"""Workers that cannot import this package run its queries: all code travels with the job."""

import os
import subprocess
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry

def importable(_):
    try:
        import ledgerlens.schema
    except ImportError:
        return ["no"]
    return ["yes"]

assert spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect() == ["no"]
for name in sys.argv[4:]:
    print(name, entry.queries()[name](spark, sys.argv[2]).count())
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_queries_without_the_package(tmp_path):
    names = ["op1_token_records", "op5_benchmark_leaks", "op7_minhash_near_dedup", "op8_language_id", "op11_whitening", "op12_collocations", "op13_byte_bpe"]
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT, REPO, FOLDER, str(tmp_path / "checkpoints"), *names]
    done = subprocess.run(command, cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names
