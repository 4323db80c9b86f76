"""The driver's entry stands without the optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}")
sys.meta_path.insert(0, Missing())
import __spark_entry__, catalog
assert set(__spark_entry__.queries()) == set(catalog.queries()), len(__spark_entry__.queries())
assert set(__spark_entry__.oracle_sql()) == set(catalog.oracles())
"""


@pytest.mark.parametrize("name", ["ahocorasick", "roadpulse.llm", "corpus_pipeline"])
def test_entry_without_a_library_a_folder_or_the_pipeline(name):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert "without the training-data operators" in done.stderr
