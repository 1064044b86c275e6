"""The entry point works without the optional training-data part."""
import subprocess
import sys
from pathlib import Path


def test_entry_without_the_optional_part():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert 'pipeline' not in q and not [k for k in q if k.startswith('op1_')]; "
            "assert set(e.oracle_sql()) <= set(q) and len(q) > 150; assert 'tessera.llm' not in sys.modules")
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_nothing_else_imports_it():
    root = Path(__file__).resolve().parents[1]
    for path in root.glob("tessera/**/*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
