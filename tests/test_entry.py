"""The driver's contract, with the training-data operators and without them."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def said(at):
    out = subprocess.run([sys.executable, "-c", SAYS], cwd=at, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert out.returncode == 0, out.stderr
    return [set(line.split()) for line in out.stdout.splitlines()]


def test_queries_without_the_training_data_operators(tmp_path):
    import tessera.plans.build  # noqa: F401
    from tessera.plans.queries import ORACLE_SQL, QUERIES

    shutil.copytree(ROOT, tmp_path / "a", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    assert said(tmp_path / "a") == [set(QUERIES), set(ORACLE_SQL)]
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path / "a")
    (tmp_path / "a" / "corpus_pipeline.py").write_text("from tessera.llm import bpe\n")  # left behind without what it imports
    assert said(tmp_path / "a") == [set(QUERIES), set(ORACLE_SQL)]
    with_all = said(ROOT)
    assert with_all[0] >= set(QUERIES)
