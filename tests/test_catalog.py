"""Every registered query against its SQL on the smallest tables (skipped where they are absent)."""

import os
import subprocess
import sys

import pytest
from compare import compare, connect

from loomtext.plans import catalog

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, catalog.QUERIES[name], catalog.ORACLES[name], SF) == ""


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_library_does_not_import_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, importlib, pathlib\n"
        "for p in sorted(pathlib.Path('loomtext').rglob('*.py')):\n"
        "    if 'llm' not in p.parts and p.name != '__init__.py': importlib.import_module('.'.join(p.with_suffix('').parts))\n"
        "assert not any(m.startswith('loomtext.llm') for m in sys.modules)"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


def test_entry_without_llm(tmp_path):
    """The entry module imports and lists the other queries when the subpackage and pipeline are gone."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/loomtext", tmp_path / "loomtext", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0
