"""Every registered query against its SQL on the smallest tables."""

import re

import oracle
import pytest

import __spark_entry__ as entry_module

ORACLES = entry_module.oracle_sql()


def differences(df, con, sql):
    """Empty results are fine at the smallest scale."""
    return [p for p in oracle.compare(df, con, sql) if p != "no rows"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    own = {n for n in entry_module.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own == {n for n in ORACLES if not re.match(r"op\d+_", n)}


@pytest.mark.parametrize("name", [n for n in ORACLES if not re.match(r"campus_|op\d+_", n)])
def test_operator_query(spark, sf_dir, con, name):
    assert differences(entry_module.queries()[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["campus_conflicts_student", "campus_sync_identity_roles", "campus_attendance_not_taken", "campus_weekly_schedule", "campus_repair_addresses"])
def test_campus_query_on_derived_tables(spark, sf_dir, con, name):
    assert differences(entry_module.queries()[name](spark, sf_dir), con, ORACLES[name]) == []
