import datetime as dt

import pytest

from tests.test_models import CONFIG, bronze
from tidemark.plans import checks, detectors, metrics, serving
from tidemark.plans.models import Warehouse
from tidemark.queries import house


def test_numerators_are_part_of_denominators(spark, small):
    h = house(spark, small)
    for by in ([], ["agency"], ["season"], ["metric_time__year"]):
        for r in metrics.metric_query(h, metrics.METRICS, by).collect():
            assert r.closed_and_settled_count <= r.settled_count_excl_backlog <= r.settled_count <= r.request_count
            assert r.closed_count <= r.request_count and (r.closure_rate_excl_backlog is None or 0 <= r.closure_rate_excl_backlog <= 1)
    with pytest.raises(ValueError, match="unknown"):
        metrics.metric_query(h, ["nothing"])


def test_a_filter_cannot_let_censored_rows_in(spark, small):
    h = house(spark, small)
    one = metrics.metric_query(h, ["median_resolution_hours", "request_count"], [], "is_censored").first()
    assert one.median_resolution_hours is None and one.request_count > 0


def test_empty_tables(spark):
    h = Warehouse(bronze(spark), CONFIG)
    assert [r.status for r in checks.scorecard_checks(h).orderBy("check_name").collect()] == ["pass", "fail", "pass", "fail", "fail", "fail"]
    assert [r.check_name for r in checks.failed_rows(h).collect()] == ["row_count_volume"]  # an empty cohort passes here
    assert detectors.mass_touch(h).count() == detectors.composition_drift(h).count() == 0
    assert serving.overview(h).first().closure_rate_pct is None
    assert set(serving.serving_tables(h, h.fact)) == {
        "overview", "agency_performance", "geo_equity", "geo_equity_missing_coords", "seasonality", "dq_scorecard", "dq_settlement_completeness", "dq_vocabulary_drift", "dq_mass_touch",
        "dq_resolution_hours_naive_vs_correct",
    }


def test_null_threshold_keeps_null_verdict(spark):
    """Hours above the cap only: there is no ordinary night, so nothing is known."""
    import dataclasses

    rows = [{"unique_key": f"{k}", "agency": f"A{k}", "agency_name": "n", "complaint_type": "T", "created_date": dt.datetime(2026, 1, 1), "updated_at": dt.datetime(2026, 1, 2, 1)} for k in range(13)]
    h = Warehouse(bronze(spark, *rows), dataclasses.replace(CONFIG, touch_ordinary_below=1))
    assert [r.fired for r in detectors.mass_touch(h).collect()] == [None]


def test_lag_bridges_missing_months_but_the_year_join_does_not(spark):
    import dataclasses

    months = [dt.datetime(2025, 1, 5), dt.datetime(2026, 1, 5), dt.datetime(2026, 3, 5)]
    rows = [{"unique_key": f"{k}", "agency": "A", "agency_name": "n", "complaint_type": "T", "created_date": m} for k, m in enumerate(months)]
    rows.append({"unique_key": "9", "agency": "B", "agency_name": "n", "complaint_type": "U", "created_date": months[2]})
    h = Warehouse(bronze(spark, *rows), dataclasses.replace(CONFIG, shift_points=15))
    shifted = {(r.item, r.month) for r in checks.failed_rows(h).where("check_name like '%shift'").collect()}
    assert ("T", dt.datetime(2026, 3, 1)) in shifted  # against January, as February has no rows
    assert [r.month for r in detectors.composition_drift(h).collect()] == [dt.datetime(2026, 1, 1)]


def test_assertions_find_what_is_wrong(spark):
    from tidemark.plans import assertions

    base = {"agency": "A", "agency_name": "n", "complaint_type": "T", "community_board": "1", "borough": "B", "status": "Closed", "created_date": dt.datetime(2026, 1, 3), "closed_date": dt.datetime(2026, 1, 1)}
    h = Warehouse(bronze(spark, base | {"unique_key": "1"}, base | {"unique_key": "1"}, base | {"unique_key": "2", "status": None}, base | {"unique_key": "3", "created_date": None}), CONFIG)
    found = {r.assertion: (r.failures, r.status) for r in assertions.model_assertions(h, closed_before_created=5).collect()}
    assert found["closed_before_created"] == (3, "warn") and found["repeated_unique_key"] == (1, "error")
    assert found["null_is_closed"] == (1, "error") and found["null_date_key"] == (1, "error")
    assert found["rows_lost_in_staging"] == found["unmatched_agency_key"] == (0, "pass")
    card = spark.createDataFrame([("contract_enforced", "contract", "dim_agency", 9.0, "odd", dt.date(2026, 1, 1))] * 2, "check_name string, category string, grain string, measured_value double, status string, run_date date")
    found = {r.assertion: r.failures for r in assertions.scorecard_assertions(card, {"dim_agency": h.agencies}).collect()}
    assert found == {"wrong_column_counts": 2, "unknown_categories": 0, "unknown_statuses": 2, "repeated_checks": 1}


def test_the_remote_warehouse_must_be_asked_for():
    from tidemark.sources.target import warehouse_uri

    assert warehouse_uri({"KEY": "x"}, "local", "remote", ("KEY",)) == "local"
    assert warehouse_uri({"KEY": "x", "TIDEMARK_REMOTE": "1"}, "local", "remote", ("KEY",)) == "remote"
    with pytest.raises(RuntimeError, match="KEY"):
        warehouse_uri({"TIDEMARK_REMOTE": "1"}, "local", "remote", ("KEY",))


def test_running_sums_equal_the_join_that_defines_them(spark, small):
    h = house(spark, small)
    first, second = (sorted(map(str, f(h).collect())) for f in (detectors.undated_closure_rate, detectors.undated_closure_rate_by_join))
    assert first == second and len(first) > 100


def test_cells_add_up_to_the_fact(spark, small):
    h = house(spark, small)
    n = h.fact.count()
    one = h.cells.selectExpr("sum(n) as n", "sum(closed) as closed", "sum(undated) as undated").first()
    assert one.n == n == h.touches.selectExpr("sum(n) as n").first().n and one.closed == h.fact.where("status = 'Closed'").count()
    assert one.undated == h.fact.where("is_undated_closure").count()
