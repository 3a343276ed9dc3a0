"""The entry stands without the optional subpackage, and without a package that only it needs."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'status_counts' in e.queries(), sorted(e.ABSENT), any(k.startswith('op') for k in e.queries()))"


def said(cwd: str, before: str = "") -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", before + SAYS], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    return run.stdout.split(maxsplit=2)


def copy(scratch: str, *left_out: str) -> str:
    at = os.path.join(scratch, "copy")
    shutil.copytree(ROOT, at, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", *left_out)])
    return at


def test_without_the_subpackage(scratch):
    n, n_sql, rest = said(copy(scratch, "llm", "corpus_pipeline.py"))
    assert n == n_sql and int(n) >= 40 and rest.split() == ["True", "['ledgerlens.llm']", "False"]


def test_without_a_package_that_it_needs(scratch):
    at = copy(scratch)
    if not os.path.isdir(f"{at}/ledgerlens/llm"):
        return
    n, n_sql, rest = said(at, "import sys; sys.modules['ahocorasick'] = None; ")
    assert n == n_sql and rest.split() == ["True", "['ledgerlens.llm']", "False"]


def test_without_the_pipeline(scratch):
    at = copy(scratch, "corpus_pipeline.py")
    if os.path.isdir(f"{at}/ledgerlens/llm"):
        assert said(at)[2].split() == ["True", "['corpus_pipeline']", "True"]
