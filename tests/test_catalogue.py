import pytest
from conftest import DATA, same_rows

from syncweave import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_matches_sql(name, spark, duck):
    same_rows(catalogue.QUERIES[name](spark, DATA), duck, catalogue.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_without_sql_runs(name, spark):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_core_does_not_import_llm():
    import pathlib

    for p in pathlib.Path(catalogue.__file__).parent.rglob("*.py"):
        text = p.read_text()
        assert "import llm" not in text and "from llm" not in text
