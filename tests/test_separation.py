"""The entry works in a copy of the tree that lacks the training-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_llm_folders(tmp_path):
    for name in ("trawl", "__spark_entry__.py", "corpus_pipeline.py"):
        src = ROOT / name
        if src.is_dir():
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif src.exists():
            shutil.copy(src, tmp_path / name)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert not any(k.startswith('op') or k == 'pipeline' for k in [*q, *o]); "
            "assert set(o) <= set(q) and len(q) > 30")
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
