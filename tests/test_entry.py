import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


def test_every_counterpart_has_its_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert len(entry.queries()) >= 90


def test_flagship(spark):
    assert entry.entry(spark).columns == ["doc_id", "n_tokens", "dwell_tenths", "sentence_ends"]


def test_imports_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "lectern", tmp_path / "lectern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sum(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries(), len(e.queries()) >= 90)"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["0", "False", "True"], run.stderr
