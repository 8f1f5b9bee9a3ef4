"""The contract without the training-data package, as a copy of the repository in a fresh process."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print('FOUND', *sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("left", ["pipeline", "caches", "nothing"])
def test_imports_without_the_training_data_package(tmp_path, left):
    """Whether the pipeline or empty folders of compiled modules stay behind or not."""
    copy = tmp_path / "copy"
    skipped = shutil.ignore_patterns(".git", "__pycache__", "llm", *["corpus_pipeline.py"] * (left == "nothing"))
    shutil.copytree(ROOT, copy, ignore=skipped)
    if left == "caches":
        (copy / "tickwright" / "llm" / "__pycache__").mkdir(parents=True)
    ran = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    found = ran.stdout.split("FOUND", 1)[1].split()
    assert len(found) >= 46 and not any(name.startswith("op") or name == "pipeline" for name in found)


def test_errors_within_the_package_are_not_swallowed(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    if not (copy / "tickwright" / "llm").exists():
        pytest.skip("no training-data package")
    with open(copy / "tickwright" / "llm" / "common.py", "a") as module:
        module.write("import a_module_that_is_not_there\n")
    ran = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode and "a_module_that_is_not_there" in ran.stderr
