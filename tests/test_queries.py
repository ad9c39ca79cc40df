"""Every core query against its SQL."""

import pytest

from siltworks.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, against_sql):
    against_sql(QUERIES[name], SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    frame = entry.entry(spark)
    assert frame.columns == ["conv_id", "n_turns", "total_chars", "content_hash"]
    assert frame.count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
