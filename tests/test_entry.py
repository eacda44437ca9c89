"""What the entry registers with and without its optional parts."""

import subprocess
import sys
from pathlib import Path

import pytest

from tallyforge.testbed import oracle, registry

ROOT = Path(__file__).parent.parent
NAMES = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


@pytest.mark.parametrize("absent", ["xxhash", "tallyforge.llm", "tallyforge.llm.registry"])
def test_other_queries_stay_without_a_module(absent):
    """A missing library or subpackage takes the optional queries with it, and nothing else."""
    code = f"import sys; sys.modules[{absent!r}] = None; {NAMES}"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, sql = (set(line.split()) for line in run.stdout.splitlines()[-2:])
    assert queries == set(registry.queries()) and sql == set(oracle.oracle_sql())
