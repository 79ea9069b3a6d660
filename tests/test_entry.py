"""The registry, with and without the folders that may be absent."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_every_sql_has_its_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "rr_impedance" in e.queries()


def test_works_without_the_optional_folders(tmp_path):
    shutil.copytree(ROOT / "terrawave", tmp_path / "terrawave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rr_impedance' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
