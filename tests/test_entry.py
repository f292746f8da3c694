import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_imports_without_the_training_operators(tmp_path):
    for name in ("__spark_entry__.py", "lessonweave"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else None
    import shutil

    shutil.copytree(ROOT / "lessonweave", tmp_path / "lessonweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert out.stdout.split()[1:] == ["False"], out.stderr
