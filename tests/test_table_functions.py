"""Gold datasets as SQL table functions."""

import contextlib
import datetime as dt
import io

import pytest

from laminar.plans import monthly_metrics
from laminar.session import fresh_dir
from laminar.sources import catalog, layers, table_functions, testdata

SF001 = "/root/testdata/sf0.001"
DAY, NEXT = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


@pytest.fixture(scope="module")
def database(spark):
    root = fresh_dir(spark, "functions")
    db = f"functions_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/database'")
    months = monthly_metrics(testdata.transactions(spark, SF001))
    for day, rows in ((DAY, months), (NEXT, months.limit(3))):
        told = layers.write_gold(rows, f"{root}/gold", "monthly_metrics", run_date=day)
        values = dict(zip(layers.LOAD_PARTITION_COLUMNS, (day.year, day.month, day.day)))
        catalog.register_run(spark, f"{db}.monthly_metrics", told["path"], values)
    return db


def _count(spark, call):
    return spark.sql(f"SELECT count(*) FROM {call}").first()[0]


def test_run_dates(spark, database):
    # a dataset with a year of its own is taken by its load date
    assert table_functions.register_run_functions(spark, database, ["monthly_metrics"]) == ["monthly_metrics_on"]
    months = monthly_metrics(testdata.transactions(spark, SF001)).count()
    assert _count(spark, f"monthly_metrics_on(DATE '{DAY}')") == months
    assert _count(spark, f"monthly_metrics_on(DATE '{NEXT}')") == 3
    assert _count(spark, "monthly_metrics_on(DATE '1999-01-01')") == 0
    assert _count(spark, "monthly_metrics_on(CAST(NULL AS DATE))") == 0


def test_a_run_date_prunes_partitions(spark, database):
    table_functions.register_run_functions(spark, database, ["monthly_metrics"])
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        spark.sql(f"SELECT monthly_revenue FROM monthly_metrics_on(DATE '{DAY}')").explain("formatted")
    line = next(x for x in told.getvalue().splitlines() if x.startswith("PartitionFilters"))
    assert "load_year" in line and "load_day" in line
    assert "ReadSchema: struct<monthly_revenue:double>" in told.getvalue()


def test_kept_for_other_sessions(spark, database):
    names = table_functions.register_run_functions(spark, database, ["monthly_metrics"], temporary=False)
    other = spark.newSession()
    other.sql(f"USE {database}")
    assert names == [f"{database}.monthly_metrics_on"]
    assert _count(other, f"monthly_metrics_on(DATE '{NEXT}')") == 3


def test_a_table_without_run_dates_is_refused(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="no run date"):
        table_functions.register_run_functions(spark, database, ["plain"])
