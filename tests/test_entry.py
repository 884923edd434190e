"""The entry points without the optional folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *[n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'])"


def _copy(target, *left_out):
    shutil.copytree(ROOT, target, ignore=lambda folder, names: [n for n in names if n.startswith((".", "__pycache__")) or os.path.relpath(os.path.join(folder, n), ROOT) in left_out])
    return target


def _listed(folder, before=""):
    run = subprocess.run([sys.executable, "-c", before + LIST], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_without_the_optional_folders(tmp_path):
    from aerolake.plans import catalog, oracle

    rest = _copy(tmp_path / "rest", "aerolake/llm", "tests/llm")
    assert (rest / "corpus_pipeline.py").exists() and not (rest / "aerolake" / "llm").exists()
    assert _listed(rest) == [str(len(catalog.queries())), str(len(oracle.oracle_sql()))]


def test_without_an_optional_library(tmp_path):
    from aerolake.plans import catalog

    missing = "import sys; sys.modules['xxhash'] = None; sys.modules['tiktoken'] = None; "
    assert _listed(ROOT, missing)[0] == str(len(catalog.queries()))


def test_all_test_files_are_collected(tmp_path):
    run = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stdout[-2000:]
