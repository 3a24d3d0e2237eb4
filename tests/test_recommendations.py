"""Item-based recommendations sum where the ratings lie."""

from minewright.registry import load_all


def test_ratings_laid_out_by_person_do_not_move(spark):
    found = load_all()["recommend_item"](spark, "/root/testdata/sf0.001")
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count()
