"""Physical-plan properties of the registered queries."""

import pytest

from conftest import SF_SMALL
from engage.plans import catalog as C
from engage.plans.oracle import SQL
from engage.sources import fixtures as FX

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow", "MapInPandas", "MapInArrow")
PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_python_and_no_products(spark, name):
    plan = _plan(C.QUERIES[name](spark, SF_SMALL))
    # (SMOTE's neighbours are needed for the rows it makes, not for counting them)
    assert not any(n in plan for n in PYTHON_NODES), name
    assert not any(n in plan for n in PRODUCTS), name


def test_window_group_limit_for_top_category(spark):
    plan = C.QUERIES["top_category_all"](spark, SF_SMALL)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(C.QUERIES["top_news"](spark, SF_SMALL))


def test_scans_are_pruned(spark):
    plan = _plan(FX.behaviors(spark, SF_SMALL))
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "o_totalprice" not in plan
    news = _plan(FX.news(spark, SF_SMALL))
    assert "p_retailprice" not in news and "n_chars" not in news


def test_texts_are_not_shuffled_with_the_interactions(spark):
    """Of the featured rows a query takes the columns it names, and titles only
    come in with the article side."""
    from engage.plans import catalog as C
    C.release(spark)
    plan = C.QUERIES["article_means"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Title" not in plan.split("InMemoryRelation")[0]
    whole = C.featured(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in whole if "Join LeftOuter" in line]
    assert "NewsID" in joins[0] and "UserID" in joins[1]


def test_brands_are_broadcast(spark):
    from engage.plans import catalog as C
    plan = C._brand_rows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "strategy=broadcast" in plan
