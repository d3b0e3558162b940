from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")


def test_sql_names_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_core_does_not_import_llm():
    root = Path(entry.__file__).parent / "folioscope"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "folioscope.llm" not in path.read_text(), path
