"""The driver contract of __spark_entry__: every query has an oracle, and the
module loads from any working directory."""

import os
import subprocess
import sys

import __spark_entry__ as E
from liqspark.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert all(isinstance(sql, str) and sql.strip() for sql in E.oracle_sql().values())


def test_entry_module_loads_from_another_directory(tmp_dir):
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', %r); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); print(len(m.queries()), len(m.oracle_sql()))") % os.path.join(ROOT, "__spark_entry__.py")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip().splitlines()[-1] == f"{len(E.queries())} {len(E.oracle_sql())}"
