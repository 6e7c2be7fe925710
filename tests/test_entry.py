"""The entry module with the optional subpackage absent, and with a fault inside it."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder):
    env = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print('pipeline' in q, len(q) > 50)"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True)


def copy(folder):
    shutil.copytree(f"{ROOT}/loomgraph", folder / "loomgraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", folder)


def test_without_the_subpackage(tmp_path):
    copy(tmp_path)
    got = run(tmp_path)
    assert got.returncode == 0 and got.stdout.split() == ["False", "True"]


def test_a_fault_inside_the_subpackage_shows(tmp_path):
    copy(tmp_path)
    (tmp_path / "loomgraph/llm").mkdir()
    (tmp_path / "loomgraph/llm/__init__.py").write_text("")
    (tmp_path / "loomgraph/llm/catalogue.py").write_text("import a_package_that_is_not_there\n")
    got = run(tmp_path)
    assert got.returncode != 0 and "a_package_that_is_not_there" in got.stderr
