import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for name in ("op1_secret_scan", "op8_toxicity", "op10_bpe", "op4_warc"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("workers ok")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "workers ok" in done.stdout, done.stderr[-2000:]
