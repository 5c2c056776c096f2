"""Every campus plan on the hand-made campus, against the same SQL that checks it at scale."""

import campus_fixture
import oracle
import pytest

from rosterline.bindings.campus import PLAIN, PLANS

# These read given or derived tables besides the campus ones.
NEEDS_GIVEN_TABLES = {"campus_insert_stops", "campus_stop_list_after", "campus_section_canceled", "campus_section_canceled_done"}


@pytest.fixture(scope="module")
def campus(spark):
    return campus_fixture.registry(spark)


@pytest.fixture(scope="module")
def con():
    return campus_fixture.duck()


@pytest.mark.parametrize("name", sorted(set(PLAIN) - NEEDS_GIVEN_TABLES))
def test_plan(campus, con, name):
    problems = oracle.compare(PLANS[name](campus), con, PLAIN[name])
    assert [p for p in problems if p != "no rows"] == []
