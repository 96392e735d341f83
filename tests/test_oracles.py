"""Every query of the library that SQL expresses gives the rows of its SQL."""

from __future__ import annotations

import pytest

from quillstone import plans

from . import test_plain
from .oracle import assert_equal


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_rows_equal_sql(spark, sf, name):
    assert assert_equal(plans.QUERIES[name](spark, sf), plans.ORACLE_SQL[name], sf) >= 0


def test_queries_without_sql_are_checked_plainly():
    """What SQL does not express is compared with plain Python in test_plain and test_reports."""
    assert set(plans.QUERIES) - set(plans.ORACLE_SQL) == set(test_plain.CHECKED) | {"p3_resemblance", "t6_template_report"}
