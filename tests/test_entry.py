"""The entry module works without the training-data operators."""

import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import sys
for name in ("velocart.llm", "corpus_pipeline"):
    sys.modules[name] = None
import __spark_entry__ as entry
from velocart.plans.registry import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
"""


def test_entry_without_the_training_data_operators():
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_them():
    import pathlib

    for file in pathlib.Path(ROOT, "velocart").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "velocart.llm" not in file.read_text() and "corpus_pipeline" not in file.read_text(), file
