"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from emberline import catalog

QUERIES, SQL = dict(catalog.QUERIES), dict(catalog.ORACLES)


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    got = oracle.spark_rows(QUERIES[name](spark, small))
    if name in SQL:
        assert oracle.difference(got, oracle.duck_rows(duck, SQL[name])) is None
    else:
        assert got[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(SQL) <= set(QUERIES)


def test_coverage_table_names_real_queries():
    import pathlib
    import re

    text = (pathlib.Path(entry.__file__).parent / "COVERAGE.md").read_text()
    named = {q for line in text.splitlines() if line.startswith("| ") for q in re.findall(r"`([a-z0-9_]+)`", line.split("|")[3])}
    assert named == set(QUERIES)
