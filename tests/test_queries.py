"""Every registered query against its DuckDB statement on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from compare import frames_equal

SF_DIR = "/root/testdata/sf0.001"
SQL = spark_entry.oracle_sql()
QUERIES = spark_entry.queries()

# Whole models take long in SQL: some are compared on larger data, the hourly ones, whose systems are
# mostly singular, on the smallest.
MODEL_SF_DIR = "/root/testdata/sf0.01"
ALL_WHOLE_MODELS = {name for name in SQL if "_day_" in name and not name.startswith("footfall")} | {
    "influence_hour_all_floor",
    "popularity_hour_all_floor",
    "circulation_hour_all_floor",
    "circulation_hour_floor",
    "var_select_bic",
    "var_coefficients",
    "var_sigma",
    "var_loglik",
    "var_ic",
    "var_select_order",
    "ma_coefficients",
    "impulse_response",
    "fevd",
    "granger_pairs",
    "sparse_var_fit",
}
WHOLE_MODELS = ("var_ic", "var_coefficients", "influence_day_all", "circulation_day_floor", "ma_coefficients", "granger_pairs", "sparse_var_fit")


def connect(sf_dir):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - ALL_WHOLE_MODELS))
def test_query_matches(spark, duck, name):
    assert frames_equal(QUERIES[name](spark, SF_DIR).toPandas(), duck.execute(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", WHOLE_MODELS)
def test_whole_model_matches(spark, name):
    want = connect(MODEL_SF_DIR).execute(SQL[name]).df()
    assert frames_equal(QUERIES[name](spark, MODEL_SF_DIR).toPandas(), want) == ""


@pytest.mark.parametrize("name", ["influence_day_sparse"])
def test_model_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_publish_all_holds_every_day(spark, duck, tmp_path):
    """Hourly tables as well, on two days."""
    duck.execute(f"COPY (SELECT * FROM events WHERE ts < DATE '2024-01-03') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    got = QUERIES["publish_all"](spark, str(tmp_path)).toPandas()
    assert frames_equal(got, connect(str(tmp_path)).execute(SQL["publish_all"]).df()) == ""
    days = {grain: set(part.date) for grain, part in got.groupby("grain")}
    assert days["hour"] == days["day"] and len(days["day"]) == 2
