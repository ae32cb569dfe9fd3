"""Executors that do not have this package."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.append({repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def missing(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("faretide") is not None]}})

assert not spark.range(1).mapInArrow(missing, "found boolean").first()[0], "workers have the package"
from faretide.llm.queries import QUERIES
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
docs.write.parquet({folder!r} + "/documents.parquet")
for name in ("pages", "embeddings"):
    table = spark.read.parquet("/root/testdata/sf0.001/" + name + ".parquet")
    table.limit(40).write.parquet({folder!r} + "/" + name + ".parquet")
for name, query in QUERIES.items():
    print(name, query(spark, {folder!r}).count())
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, folder=str(tmp_path / "data"))
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=600, check=False,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split("\n")) >= 13
