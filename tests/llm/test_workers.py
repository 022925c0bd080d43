"""Workers need no copy of the package: every query with Python workers runs from another folder, with
nothing on the workers' import path."""

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

SCRIPT = """
import sys, tempfile
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-test-ckpt-"))
import __spark_entry__ as E
queries = E.queries()
for name in ("op1_exact_dedup", "op2_html_extract", "op3_quality_gbt", "op4_dac_tokens", "op5_ngram_jaccard", "op7_sentencepiece",
             "op8_token_counts", "op11_whitening", "op12_pivot_clusters", "op13_minhash"):
    assert queries[name](spark, {sf!r}).count() > 0, name
    print("ran", name)
"""


def test_queries_run_without_the_package_on_the_workers_path(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, sf=SF_SMALL)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert done.stdout.count("ran ") == 10, done.stderr[-3000:]
