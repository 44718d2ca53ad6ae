from trendflow.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_reused_and_scratch_below_it(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first  # set once, then reused
    scratch = scratch_path(spark, "x")
    assert scratch.startswith(first.rstrip("/")) and scratch != scratch_path(spark, "x")


def test_package_reaches_workers_that_do_not_have_it(tmp_path):
    """Executors in another folder, without the repository on their path."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from trendflow.session import local_session, ship_package
spark = local_session(2, 2)
ship_package(spark)
from pyspark.sql import functions as F
def run(batches):
    import os
    import trendflow
    assert "trendflow.zip" in trendflow.__file__, trendflow.__file__
    yield from batches
print("rows", spark.range(5).mapInArrow(run, "id long").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows 5" in out.stdout, out.stderr[-2000:]
