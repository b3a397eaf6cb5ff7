"""Regression tests of the third round of findings."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
from ratelens.sources.driver import DRIVER_TABLES, table_path
from tests.conftest import SF_SMALL


def test_classification_report_equals_its_sql(spark):
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    name = "g19_classification_report"
    got = rows_of(entry.queries()[name](spark, SF_SMALL).toPandas())
    assert got[1] and got == rows_of(con.execute(entry.oracle_sql()[name]).fetchdf())


def test_lasso_covers_every_basis_and_target(spark):
    from ratelens.plans.q_ml import RATE_BASES, TARGET_NAMES
    got = entry.queries()["g17_lasso_cv"](spark, SF_SMALL).select("rate_basis", "target_variable").distinct().collect()
    assert {tuple(r) for r in got} == {(b, t) for b in RATE_BASES for t in TARGET_NAMES}
