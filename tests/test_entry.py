"""The driver's entry without the optional subpackage, and with a broken one."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = os.path.join(ROOT, "tastegraph", "llm")


def run(folder, code):
    env = {**os.environ, "PYTHONPATH": str(folder)}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


@pytest.fixture()
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    shutil.copytree(os.path.join(ROOT, "tastegraph"), tmp_path / "tastegraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return tmp_path


def test_entry_without_the_optional_part(copy):
    if (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    out = run(copy, "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())))")
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= 46 and out.stdout.strip().endswith("[]")


@pytest.mark.skipif(not os.path.isdir(OPTIONAL), reason="the optional part is absent")
def test_entry_does_not_hide_a_broken_part(copy):
    shutil.copytree(OPTIONAL, copy / "tastegraph" / "llm", ignore=shutil.ignore_patterns("__pycache__"))
    (copy / "tastegraph" / "llm" / "urls.py").write_text("import a_package_that_is_not_there\n")
    out = run(copy, "import __spark_entry__")
    assert out.returncode != 0 and "a_package_that_is_not_there" in out.stderr
