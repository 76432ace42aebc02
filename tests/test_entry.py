import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["level", "antecedent", "consequent", "support", "confidence", "lift"]
    assert df.count() == 883


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
