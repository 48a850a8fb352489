import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).resolve().parent


def test_every_query_has_sql():
    assert not set(entry.QUERIES) - set(entry.oracle_sql())
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_imports_without_the_subpackage_and_with_or_without_the_pipeline(tmp_path):
    copied = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(ROOT / "tokenloom", tmp_path / "tokenloom", ignore=copied)
    for name in ("__spark_entry__.py", "oracle_queries.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; assert 'pipeline' not in e.queries(); print(len(e.queries()), len(e.oracle_sql()))"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        assert done.stdout.split()[0] == str(len(entry.QUERIES))
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["seq_id", "input_ids", "labels", "label_shift"]
    rows = df.collect()
    assert rows and all(len(r.input_ids) == len(r.labels) == 64 for r in rows)
    assert all(r.input_ids[1:] == r.labels[:-1] for r in rows)
