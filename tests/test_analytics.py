from conftest import rows
from engage.operators import analytics as AN


def _ds(spark, data):
    return spark.createDataFrame(
        data, "UserID string, NewsID string, Click int, Category string, Title string, "
              "user_ctr double, preferred_category string, top_category_affinity double, "
              "activity_encoded int")


ROWS = [
    ("U1", "N1", 1, "a", "t1", 0.5, "a", 1.0, 0),
    ("U1", "N2", 0, "b", "t2", 0.5, "a", 1.0, 0),
    ("U2", "N1", 1, "a", "t1", 1.0, "a", 0.5, 0),
    ("U2", "N3", 1, None, None, 1.0, "a", 0.5, 0),
    ("U2", "N4", 1, "b", "t4", 1.0, "a", 0.5, 0),
]


def test_category_ctr_null_group(spark):
    ds = _ds(spark, ROWS)
    got = {r.Category: (r.clicks, r.total) for r in AN.category_ctr(ds).collect()}
    assert got == {"a": (2, 2), "b": (1, 2), None: (1, 1)}
    assert None not in {r.Category for r in AN.category_ctr(ds, drop_null=True).collect()}
    assert None not in {r.Category for r in AN.category_trend(ds).collect()}


def test_profile_mode_smallest_on_ties(spark):
    ds = _ds(spark, ROWS)
    got = {r.UserID: (r.total_clicks, r.total_impressions, r.preferred_category, r.ctr)
           for r in AN.user_profile_mode(ds).collect()}
    # U2 clicked a, b and a null category once each: nulls skipped, smallest wins
    assert got == {"U1": (1, 2, "a", 0.5), "U2": (3, 3, "a", 1.0)}


def test_profile_collection(spark):
    got = {r.UserID: r for r in AN.user_profile(_ds(spark, ROWS), "U2").collect()}
    assert list(got) == ["U2"]
    assert got["U2"].total_clicks == 3 and got["U2"].avg_user_ctr == 1.0


def test_activity_distribution_lists_empty_bins(spark):
    got = rows(AN.activity_distribution(_ds(spark, ROWS)), order=False)
    assert got == [("Low", 2), ("Medium", 0), ("High", 0), ("Very High", 0)]


def test_histogram_puts_one_in_last_bin(spark):
    got = {r.bin: r.users for r in AN.user_ctr_histogram(_ds(spark, ROWS)).collect()}
    assert got == {16: 1, 30: 1}


def test_top_k_cap(spark):
    import pytest
    with pytest.raises(ValueError):
        AN.top_news(_ds(spark, ROWS), k=101)
    top = AN.top_news(_ds(spark, ROWS), k=2).collect()
    assert [r.NewsID for r in top] == ["N1", "N3"]


def test_platform_stats(spark):
    r = AN.platform_stats(_ds(spark, ROWS)).first()
    assert (r.total_users, r.total_news, r.total_interactions, r.total_clicks) == (2, 4, 5, 4)
    assert r.overall_ctr == 0.8
