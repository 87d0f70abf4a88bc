"""The entry points."""

import __spark_entry__ as entry


def test_names_fit():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 45 and all(map(callable, queries.values()))


def test_flagship(spark):
    got = entry.entry(spark)
    assert got.columns == ["section_id", "label", "n"] and got.count() > 0
