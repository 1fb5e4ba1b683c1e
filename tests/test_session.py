"""The launcher decides the master; checkpoints need a shared folder outside local mode."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT
from curbline.session import ensure_checkpoint_dir


def test_submitted_master_stands():
    code = "from curbline.session import build_session; s = build_session(); print('MASTER', s.sparkContext.master)"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell", "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "MASTER local[2]" in out.stdout, out.stderr[-2000:]


def test_no_private_folder_on_a_cluster():
    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
