"""The package reaches executors that do not have it on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
n = e.queries()["popular"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_stages_can_be_dropped(spark):
    from affinis import session

    before = session.stage_count()
    df = session.cut_lineage(spark.range(3).toDF("x"))
    path = session._stages.paths[-1]
    assert df.count() == 3
    assert session.drop_stages(spark, before) == 1
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
