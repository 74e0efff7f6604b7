"""The driver's entry points, also without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "loquarium", tmp_path / "loquarium", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rover_scores' in q and not any(n.startswith('op') and n[2:3].isdigit() for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_imports_llm():
    for p in (ROOT / "loquarium").rglob("*.py"):
        if "llm" not in p.parts:
            assert "loquarium.llm" not in p.read_text(), p


def test_entry(spark):
    import __spark_entry__

    if Path("/root/testdata/sf0.001").exists():
        assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
