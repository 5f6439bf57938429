import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_missing_operators_leave_the_rest(tmp_path):
    """Without the subpackage and the pipeline, the entry point still imports and has its other queries."""
    import os
    import shutil
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{here}/docsink", tmp_path / "docsink", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert 'latest_documents' in q and not any(x.startswith('op') for x in q) and 'pipeline' not in q"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
