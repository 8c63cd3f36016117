"""Every registered query against its SQL, and the streams without SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from brooktext.plans import queries
from check import rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    result = contract.queries()[name](spark, SF_DIR)
    got = rows_of(result.columns, [tuple(row) for row in result.collect()])
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_score_all_covers_every_record_and_model(spark, db):
    n = db.execute("SELECT count(*) FROM labels").fetchone()[0]
    result = contract.queries()["score_all"](spark, SF_DIR)
    assert {r.model: r["count"] for r in result.groupBy("model").count().collect()} == {
        name: n for name in ("LR", "SGD", "MLP", "MNB", "KMEANS")
    }


def test_train_all_reports_every_model_and_batch(spark, db):
    n = db.execute("SELECT count(*) FROM labels").fetchone()[0]
    rows = contract.queries()["train_all"](spark, SF_DIR).collect()
    assert {r.model for r in rows} == {"LR", "SGD", "MLP", "MNB", "KMEANS"}
    assert {model: sum(r.n for r in rows if r.model == model) for model in {r.model for r in rows}} == {
        model: n for model in {r.model for r in rows}
    }
    assert all(r.n == r.tn + r.fp + r.fn + r.tp for r in rows)


def test_entry_has_one_metrics_row(spark):
    assert contract.entry(spark).count() == 1


def test_local_solvers_learn_on_a_stream(spark):
    """On sf0.1 both find rare-class records and beat the constant answer by the last batch."""
    rows = queries.train_stream(spark, "/root/testdata/sf0.1", models=("SGD", "MLP")).metrics().collect()
    last = max(r.batch_id for r in rows)
    for r in (r for r in rows if r.batch_id == last):
        assert r.tp > 0 and r.tn > 0, r.model
        assert r.accuracy > (r.tn + r.fp) / r.n, r.model
