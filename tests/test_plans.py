"""Shapes of the physical plans."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from lodgeframe.queries import QUERIES, Tables
from tests.helpers import plan

SF = "/root/testdata/sf0.001"
NARROW = ["calendar_gold", "reviews_gold", "clean_text", "clean_currency", "event_label", "haversine", "publish_payload"]


@pytest.fixture(scope="module")
def tables(spark) -> Tables:
    return Tables(spark, SF)


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(tables, name):
    assert "Exchange" not in plan(QUERIES[name].run(tables)).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", ["t_test", "listings_gold", "word_freq", "box_stats", "dq_report", "occupancy_trend", "change_flags", "impute_median_noise"])
def test_no_python_and_no_cross_join(tables, name):
    physical = plan(QUERIES[name].run(tables)).split("== Physical Plan ==")[1]
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in physical


def test_scans_read_only_what_they_use(tables):
    physical = plan(QUERIES["rate_by_key"].run(tables)).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in physical
    physical = plan(QUERIES["semi_join"].run(tables)).split("== Physical Plan ==")[1]
    assert "EqualTo(quality,1)" in physical


def test_top_k_is_not_a_full_sort(tables):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_counts"].run(tables))


def test_counts_combine_before_the_shuffle(tables):
    physical = plan(QUERIES["word_freq"].run(tables)).split("== Physical Plan ==")[1]
    assert "partial_count" in physical


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == set()


def test_report_payloads(spark, tables):
    import json

    from lodgeframe.plans import reports
    from lodgeframe.queries.gold import REPORTS

    for name, sections in (("listings", reports.LISTINGS), ("calendar", reports.CALENDAR), ("reviews", reports.REVIEWS)):
        parts = {r["section"]: json.loads(r["content"]) for r in reports.payload(reports.build(sections, REPORTS[name][0](tables))).collect()}
        assert set(parts) == set(sections) and all(parts.values())
        for column, digits in (("price_hist", 1), ("price_log_hist", 2)):
            assert all(round(b["left"], digits) == b["left"] for b in parts.get(column, []))
