"""The entry point lists the reports whether or not the optional parts are there."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from ledgerloom.plans.registry import QUERIES

ROOT = Path(__file__).resolve().parent.parent
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder: Path) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True,
                          env={"PYTHONPATH": str(folder), "PATH": "/usr/bin:/bin"}, check=False)


@pytest.fixture
def bare(tmp_path):
    """A copy of the library without the optional subpackage."""
    shutil.copytree(ROOT / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_reports_without_the_optional_subpackage(bare, with_pipeline):
    if with_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", bare)
    queries, oracles = json.loads(listed(bare).stdout)
    assert queries == oracles == sorted(QUERIES)


def test_a_fault_inside_the_subpackage_is_not_hidden(bare):
    (bare / "ledgerloom" / "llm").mkdir()
    (bare / "ledgerloom" / "llm" / "__init__.py").write_text("")
    (bare / "ledgerloom" / "llm" / "registry.py").write_text("import no_such_module")
    run = listed(bare)
    assert run.returncode != 0 and "no_such_module" in run.stderr
