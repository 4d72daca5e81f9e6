import subprocess
import sys
from pathlib import Path


def test_queries_can_be_listed_without_a_session():
    """The catalogue is read before any session is there."""
    run = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=True)
    assert int(run.stdout) > 90
