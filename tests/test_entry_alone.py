import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_library_stands_without_the_training_data_package(tmp_path):
    """A copy without the package and its tests, with and without the pipeline's file."""
    shutil.copytree(os.path.join(HERE, "tidemark"), tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(HERE, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as E; from tidemark.plans import registry; q, o = E.queries(), E.oracle_sql(); "
            "assert set(registry.QUERIES) <= set(q) and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; "
            "assert o and set(o) <= set(q)")
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert (got := run()).returncode == 0, got.stderr
    with open(tmp_path / "corpus_pipeline.py", "w") as f:
        f.write("from tidemark.llm import bpe\n")
    assert (got := run()).returncode == 0, got.stderr
    (tmp_path / "tidemark" / "llm").mkdir()  # an emptied folder is no package either
    assert (got := run()).returncode == 0, got.stderr
