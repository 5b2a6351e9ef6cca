import __spark_entry__ as entry
from copse.plans import catalog


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_total == 1500


def test_every_classifier_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
