import os
import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_entry_module_works_where_the_corpus_operators_are_gone(tmp_path):
    shutil.copytree(ROOT / "syncweave", tmp_path / "syncweave")
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not [k for k in q if k[:2] == 'op' and k[2].isdigit()]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
