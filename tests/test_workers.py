import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from regflow.catalog.adapter import workbook_bytes
from regflow.operators import archive
from regflow.sources import reports
rows = [(f"/r/{{i}}.xlsx", workbook_bytes([["t"], [], [], [None, None, "DIESEL"], ["1", "BUS", "5"]])) for i in range(3)]
files = spark.createDataFrame(rows, "path string, content binary")
assert reports.with_validity(files).filter("valid").count() == 3
assert reports.read_workbooks(files).count() == 3
assert archive.copy_files(files, "/r", "file://{target}") == 3
print("workers ok")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=str(ROOT), target=tmp_path / "out"))
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=180
    )
    assert "workers ok" in done.stdout, done.stderr[-2000:]
