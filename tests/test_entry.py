import __spark_entry__


def test_entry(spark, sf_dir):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["method", "code", "n"] and found.count() > 0


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
