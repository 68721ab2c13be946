"""A session without the machine's defaults."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
from credence.session import checkpoint_root, local_session, materialize, work_dir
spark = local_session(2, 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None, "the machine's defaults are in use"
assert materialize(spark.range(3)).count() == 3
spark.range(3).write.parquet(work_dir(spark, "t"))
assert checkpoint_root(spark) == checkpoint_root(spark) and "{folder}" in checkpoint_root(spark)
print("started")
"""


def test_session_starts_without_defaults(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "CREDENCE_CHECKPOINT_DIR": str(tmp_path / "work"), "PYTHONPATH": ROOT}
    run = subprocess.run([sys.executable, "-c", CODE.replace("{folder}", str(tmp_path / "work"))], env=env, capture_output=True, text=True, timeout=240)
    assert run.stdout.strip().endswith("started"), run.stderr[-2000:]
