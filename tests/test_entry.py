"""The entry points without the training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract

HOME = Path(contract.__file__).parent
ASK = "import __spark_entry__ as c; print(len(c.queries()), sorted(n for n in c.queries() if n == 'pipeline' or n.startswith('op')))"


@pytest.fixture
def copied(tmp_path):
    shutil.copy(HOME / "__spark_entry__.py", tmp_path)
    shutil.copytree(HOME / "tallybook", tmp_path / "tallybook", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    return tmp_path


def asked(folder):
    return subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True)


def test_entry_without_the_training_data_part(copied):
    from tallybook.queries import QUERIES

    assert asked(copied).stdout.strip() == f"{len(QUERIES)} []"


def test_a_fault_inside_that_part_is_not_swallowed(copied):
    (copied / "tallybook" / "llm").mkdir()
    (copied / "tallybook" / "llm" / "__init__.py").write_text("")
    (copied / "tallybook" / "llm" / "queries.py").write_text("import no_such_module\n")
    assert "no_such_module" in asked(copied).stderr
