"""The entry without the subpackage for training data, or without what only that needs."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(' '.join(sorted(q)))"


def names(folder, prelude=""):
    done = subprocess.run([sys.executable, "-c", prelude + LIST], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    folder = tmp_path_factory.mktemp("copy")
    shutil.copytree(f"{ROOT}/edilake", folder / "edilake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", folder)
    return folder


def test_without_the_subpackage(copy):
    found = names(copy)
    assert "billed_amounts" in found and not any(n.startswith("op") or n == "pipeline" for n in found)


@pytest.mark.skipif(not os.path.exists(f"{ROOT}/corpus_pipeline.py"), reason="the pipeline is not there")
def test_pipeline_without_its_subpackage(copy):
    shutil.copy(f"{ROOT}/corpus_pipeline.py", copy)
    assert names(copy) == names(copy, "") and "pipeline" not in names(copy)


@pytest.mark.skipif(not os.path.exists(f"{ROOT}/edilake/llm"), reason="the subpackage is not there")
def test_without_a_library_of_the_subpackage():
    found = names(ROOT, "import sys; sys.modules['zstandard'] = None; ")
    assert "billed_amounts" in found and "pipeline" not in found
