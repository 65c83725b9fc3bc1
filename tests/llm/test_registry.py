import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as E

ROOT = Path(E.__file__).resolve().parent


def test_one_query_per_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_subpackage(tmp_path):
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT)
        if "llm" not in rel.parts and rel.name != "corpus_pipeline.py":
            (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / rel).write_text(p.read_text())
    code = "import __spark_entry__ as E; assert E.queries() and not [n for n in E.queries() if n[:3] in ('op1', 'op2', 'op9')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "dimstar").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", p.read_text()), p  # not as in fullmatch
