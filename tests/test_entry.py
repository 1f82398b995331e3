import __spark_entry__ as contract


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_core_does_not_import_the_corpus_package():
    from pathlib import Path

    root = Path(contract.__file__).parent / "leafwork"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "leafwork.llm" not in path.read_text()
