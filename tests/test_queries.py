import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect, rows_of

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    assert compare(spark, con, SF, name, contract.queries()[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL)))
def test_runs(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 25


@pytest.mark.parametrize("name", ["profile_columns", "nb_predict", "linreg_fit", "dbscan_labels", "split_holdout", "transform_onehot"])
def test_partitioning_does_not_matter(spark, monkeypatch, name):
    from tabml.plans import queries

    read = queries.table
    plain = contract.queries()[name](spark, SF)
    want = rows_of(plain.columns, plain.collect())
    for parts in (1, 17):
        monkeypatch.setattr(queries, "table", lambda s, d, n: read(s, d, n).repartition(parts))
        df = contract.queries()[name](spark, SF)
        assert rows_of(df.columns, df.collect()) == want
