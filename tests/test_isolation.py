"""The library must work without the optional subpackage."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).parent.parent
CODE = """
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
queries = entry.queries()
assert not any(name.startswith("op") or name == "pipeline" for name in queries)
assert entry.entry(spark).count() > 0
for name in ("a1_majority", "t1_clean_query", "k4_redirect_table"):
    assert queries[name](spark, entry.SMOKE_DIR).count() > 0
assert set(entry.oracle_sql()) <= set(queries)
"""


def test_nothing_else_imports_the_subpackage():
    optional = "eventloom" + ".llm"
    for path in (ROOT / "eventloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert optional not in path.read_text(), path


def test_queries_run_without_it(tmp_path):
    """In a copy without the two folders and the pipeline, the entry imports and its queries run."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".*cache"))
    assert not (copy / "eventloom" / "llm").exists() and not (copy / "tests" / "llm").exists()
    subprocess.run([sys.executable, "-c", CODE], cwd=copy, check=True, timeout=300)
