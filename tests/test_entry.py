"""The entry without the text operators or a library they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
names = e.queries()
assert not any(n.startswith("op1") or n == "pipeline" for n in names) and "predicted_ratings" in names
assert set(e.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("name", ["earshot.llm", "xxhash", "public_tokenizers"])
def test_core_queries_stand_alone(name):
    subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, check=True, timeout=120)
