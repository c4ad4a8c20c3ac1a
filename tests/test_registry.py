import pytest

import __spark_entry__ as entry
from oracle import difference

SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["fecha_emision", "tipo_dte", "n_lines", "monto_total", "n_error", "n_warn"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(spark, SMALL, name, entry.queries()[name], entry.oracle_sql()[name]) is None
