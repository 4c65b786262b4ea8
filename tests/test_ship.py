"""A script elsewhere can run Python operators once the package is shipped, and the entry works without the training operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
from loomwright.ship import ship
from loomwright.operators.vectors import blocked_pairs
ship(spark)
df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0])], "id long, day long, vector array<double>")
print("PAIRS", blocked_pairs(df, 0, 0.5).count())
"""


def run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK") and not k.startswith("SPARK")}
    keep = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != REPO]
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env | {"PYTHONPATH": os.pathsep.join(keep)}, capture_output=True, text=True, timeout=240)


def test_shipped_package_reaches_workers(tmp_path):
    out = run(SCRIPT.format(repo=REPO), tmp_path)
    assert "PAIRS 1" in out.stdout, out.stderr[-2000:]


def test_entry_without_training_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    shutil.rmtree(copy / "loomwright" / "llm")
    (copy / "corpus_pipeline.py").unlink()
    out = run("import __spark_entry__ as e; q = e.queries(); print('QUERIES', len(q), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q)", copy)
    assert "QUERIES" in out.stdout and out.stdout.split("QUERIES")[1].split()[1:] == ["False", "False"], out.stderr[-2000:]
