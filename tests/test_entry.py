"""The entry module of a checkout without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(tmp_dir, *without):
    def ignore(folder, names):
        inside = os.path.relpath(folder, ROOT)
        return [n for n in names if n in (".git", "__pycache__") or os.path.normpath(os.path.join(inside, n)) in without]

    target = os.path.join(tmp_dir, "copy")
    shutil.copytree(ROOT, target, ignore=ignore)
    return target


def _keys(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([folder, os.environ.get("PYTHONPATH", "")])}
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True)
    n, n_sql, pipeline = out.stdout.split()
    return int(n), int(n_sql), pipeline == "True"


def test_entry_imports_without_the_training_data_folders(tmp_dir):
    from lakemart.plans.queries import REGISTRY
    folder = _copy(tmp_dir, os.path.join("lakemart", "llm"), os.path.join("tests", "llm"))
    assert os.path.exists(os.path.join(folder, "corpus_pipeline.py"))
    assert _keys(folder) == (len(REGISTRY), len(REGISTRY), False)


def test_entry_imports_without_the_pipeline_module(tmp_dir):
    from lakemart.plans.queries import REGISTRY
    folder = _copy(tmp_dir, os.path.join("lakemart", "llm"), os.path.join("tests", "llm"), "corpus_pipeline.py")
    assert _keys(folder) == (len(REGISTRY), len(REGISTRY), False)
