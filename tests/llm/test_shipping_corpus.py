"""Corpus operators on workers that do not have the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
)
import __spark_entry__ as contract
for name in ("op2_nearest_centroid_language", "op4_n_best_pieces", "op5_secret_blob_ledger", "op9_pivot_simhash", "op11_bitmap_rank_bpe"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() == 200
for name in ("op12_dual_tree_search", "op13_stripe_collocations"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_worker_functions_travel_by_value(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO, str(tmp_path / "shared")],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600,
    )
    assert run.returncode == 0, run.stderr[-2000:]
