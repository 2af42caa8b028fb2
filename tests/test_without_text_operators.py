"""The rest of the repository works when the text operators' folders are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_imports_without_the_text_folders(tmp_path):
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(REPO, copy, ignore=left_out)
    assert not (copy / "riskloom" / "llm").exists()
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(n for n in q if n.startswith('op') or n == 'pipeline'))"
    for gone in ((), ("corpus_pipeline.py",)):
        for name in gone:
            (copy / name).unlink(missing_ok=True)
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
        assert done.returncode == 0, done.stderr[-2000:]
        count, names = done.stdout.split(" ", 1)
        assert int(count) > 90 and names.strip() == "[]"


def test_nothing_else_imports_the_text_operators():
    files = [f for f in (REPO / "riskloom").rglob("*.py") if "llm" not in f.relative_to(REPO).parts]
    assert files and not [f for f in files if "riskloom.llm" in f.read_text() or "from .llm" in f.read_text()]
