"""The engine without its optional subpackage: imports, queries, and the guard that must not hide other failures."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=120)


def test_without_the_optional_subpackage(tmp_path):
    shutil.copytree(os.path.join(REPO, "asofmill"), tmp_path / "asofmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    done = run(tmp_path, "import __spark_entry__ as e; q = e.queries(); assert 'pit_history' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)")
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(REPO, "asofmill")):
        if "llm" not in folder:
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "llm" not in f.read(), name


def test_other_missing_modules_are_not_hidden(tmp_path):
    shutil.copytree(os.path.join(REPO, "asofmill"), tmp_path / "asofmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    done = run(tmp_path, "import __spark_entry__ as e; e.queries()")
    assert done.returncode and "no_such_module_at_all" in done.stderr
