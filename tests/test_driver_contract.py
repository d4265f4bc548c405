"""The driver's way in: a fresh interpreter, another working directory, the
entry file loaded by path. Python-worker queries must still import the
package (shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry_under_test", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .getOrCreate())
print("ENTRY", m.entry(spark).count())
print("ENRICH", m.queries()["enrich_batches"](spark, "/root/testdata/sf0.001").count())
print("QUARTILES", m.queries()["profile_numeric"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_loaded_by_path_from_other_cwd():
    cwd = tempfile.mkdtemp(prefix="cadenza-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(
        entry=os.path.join(REPO, "__spark_entry__.py"))], cwd=cwd, env=env,
        capture_output=True, text=True, timeout=600)
    lines = dict(line.split() for line in out.stdout.splitlines()
                 if line.split()[:1] and line.split()[0] in ("ENTRY", "ENRICH", "QUARTILES"))
    assert int(lines.get("ENTRY", -1)) > 0, out.stderr[-2000:]
    assert int(lines.get("ENRICH", -1)) > 0, out.stderr[-2000:]
    assert int(lines.get("QUARTILES", -1)) == 3, out.stderr[-2000:]
