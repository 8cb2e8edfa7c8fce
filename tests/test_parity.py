"""Every query with an SQL twin gives its rows; the others give some."""

import pytest

from tessella.plans import catalog
from tests.parity import compare

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: The smallest lineitem has one row twice, which has one point stand for two.
NEEDS_DISTINCT_IDS = {"c1_components", "c2_group_close", "a21_signature_counts", "a34_inter_rater", "c4_groups_with_signature", "c3_group_matches", "c6_merge_thresholds", "c11_link_planes"}
ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    compare(spark, LARGER if name in NEEDS_DISTINCT_IDS else SMALL, catalog.queries()[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES)))
def test_rows_only(spark, name):
    df = catalog.queries()[name](spark, SMALL)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
