"""plait code used inside tasks must import in the Python workers even when
the driver was started outside the repository."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import sys
sys.path.insert(0, REPO)
from pyspark.sql import SparkSession
from plait.sources import CannedUserApi, fetch
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", CP).getOrCreate())
reqs = spark.range(0, 20).selectExpr("cast(id as string) as request_key", "concat('/u/', id) as url")
print("STATUS", sorted({r.status for r in fetch(reqs, CannedUserApi(), partitions=2).collect()}))
'''


def test_fetch_runs_from_another_working_directory():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    work = tempfile.mkdtemp(prefix="plait-cwd-")
    code = SCRIPT.replace("REPO", repr(repo)).replace("CP", repr(os.path.join(work, "cp")))
    out = subprocess.run([sys.executable, "-c", code], cwd=work, capture_output=True, text=True, timeout=600)
    assert "STATUS [200, 403, 500]" in out.stdout, out.stderr[-2000:]
