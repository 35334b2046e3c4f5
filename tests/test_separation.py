"""The library without the training-data operators, and without the libraries that only they need."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = """
import sys
for name in {absent}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in entry.queries()))
"""


def counts(folder, absent=()):
    done = subprocess.run([sys.executable, "-c", COUNT.format(absent=list(absent))], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return tuple(map(int, done.stdout.split()))


@pytest.fixture
def copy(tmp_path):
    for name in ("tablebridge", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path)
    return tmp_path


def test_entry_without_the_added_folder(copy):
    total, added = counts(copy)
    assert total > 100 and not added
    if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), copy)  # the folder alone is missing
    assert counts(copy) == (total, 0)
    os.makedirs(copy / "tablebridge" / "llm" / "__pycache__")  # what a deleted folder may leave behind
    assert counts(copy) == (total, 0)


def test_entry_without_optional_libraries(copy):
    assert counts(ROOT, ("regex", "tokenizers")) == counts(copy)
