"""The driver's entry points, with and without the optional subpackage."""

import subprocess
import sys

import __spark_entry__
from conftest import ROOT

from strata.plans import catalog


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() >= 0


def test_registered():
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_optional_subpackage():
    code = "import sys; sys.modules['strata.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and e.oracle_sql(); assert not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
