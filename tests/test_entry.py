from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def entry():
    import __spark_entry__

    return __spark_entry__


def test_entry_runs(spark, entry):
    assert entry.entry(spark).count() > 0


def test_names(entry):
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 50


def test_engine_does_not_need_the_training_operators():
    """With their packages hidden, the entry still imports and has the engine's queries."""
    code = (
        "import sys\n"
        "class Hide:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('lanternflow.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(q.startswith('op') for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@pytest.mark.parametrize("name", ["url_normalize", "cohort_location", "upsert_merge", "targeted_sample", "store_records"])
def test_queries_run(spark, entry, name):
    df = entry.queries()[name](spark, SMALL)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
