"""Driver contract: entry() runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "ORDER_ID" in df.columns


def test_registry_shape():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 30


def test_cluster_conf_scales_with_input():
    from recordflow.session import cluster_conf
    small = cluster_conf(10 * 2**20, 8)
    big = cluster_conf(100 * 2**40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count() > 0


def test_every_library_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
