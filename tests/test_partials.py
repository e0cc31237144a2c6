"""Monthly sums of readings: raw columns are shuffled, hot suppliers are spread, results stay the same."""

import os

import pytest

from isotherm.plans import driver_sources as ds

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_no_sums_before_the_shuffle(spark):
    """Nearly every reading is a group of its own in a task: sums before the shuffle are wider than the readings."""
    plan = ds.monthly_partials(spark, SF)._jdf.queryExecution().executedPlan().toString()
    at = plan.index("REPARTITION_BY_COL")
    assert "partial_sum" not in plan[at:] and "Exchange" not in plan[:at].replace("+- Exchange", "", 1)


def test_hot_suppliers_give_the_same_sums(spark):
    plain = {(r.l_suppkey, r.dt): r for r in ds.monthly_partials(spark, SF).collect()}
    spread = {(r.l_suppkey, r.dt): r for r in ds.monthly_partials(spark, SF, hot_readings=20).collect()}
    some = {(r.l_suppkey, r.dt): r for r in ds.monthly_partials(spark, SF, hot_readings=600).collect()}
    assert plain.keys() == spread.keys() == some.keys()
    for other in (spread, some):
        for k, r in plain.items():
            for c in r.asDict():
                a, b = r[c], other[k][c]
                assert a == b or abs(a - b) <= 1e-9 * abs(a), (k, c, a, b)


def test_clean_looks_for_duplicates_once(spark):
    """The table and its fences read the rows written after the duplicates were removed."""
    from isotherm.operators import clean as cl
    from isotherm.plans.driver_star import build_star
    plan = cl.clean(build_star(spark, SF).enriched())._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" not in plan and "clean-rows-" in plan
