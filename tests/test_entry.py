"""The entry file: without the training-data folder, from another folder, on a cluster without a
shared folder."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from tests.conftest import ROOT, SF001


def test_entry_stands_without_a_library_of_the_added_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("cartwright.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)  # importing it raises ImportError
    found = E.queries()
    assert "dq_results" in found and not [n for n in found if n.startswith("op")]
    assert set(E.oracle_sql()) <= set(found)


def test_workers_find_the_package_from_another_folder(tmp_path):
    pytest.importorskip("cartwright.llm")
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as E\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".getOrCreate()\n"
            f"print('rows', E.queries()['op9_license_scan'](s, {SF001!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "rows 200" in out.stdout, out.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from cartwright import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
