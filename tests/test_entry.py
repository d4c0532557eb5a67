"""The entry without the optional parts: run in a process of its own on a copy of the package."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), 'hourly_circular_by_region' in q, 'pipeline' in q)"
BLOCKED = "import sys; sys.modules['tokenizers'] = None; "


def names(folder, before=""):
    done = subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


@pytest.fixture()
def copy(tmp_path):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "aerolith"), tmp_path / "aerolith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return tmp_path


def test_without_the_subpackage_and_with_a_leftover_pipeline_or_folder(copy):
    alone = names(copy)
    assert int(alone[0]) >= 107 and alone[2:] == ["True", "False"]
    (copy / "corpus_pipeline.py").write_text("from aerolith.llm import packing\n")
    assert names(copy) == alone
    (copy / "aerolith" / "llm").mkdir()
    assert names(copy) == alone


def test_without_a_package_that_the_subpackage_needs(copy):
    alone = names(copy)
    assert names(ROOT, BLOCKED)[0] == alone[0]


def test_other_errors_are_raised(copy):
    (copy / "aerolith" / "llm").mkdir()
    (copy / "aerolith" / "llm" / "queries.py").write_text("raise ValueError('broken')\n")
    with pytest.raises(AssertionError, match="broken"):
        names(copy)
