"""The driver's entry points."""

import __spark_entry__ as e


def test_entry_and_keys(spark):
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    for n in range(1, 11):
        if n in (6, 8, 9, 10):
            continue  # of the llm subpackage
        assert f"p{n}_found" in e.queries()
