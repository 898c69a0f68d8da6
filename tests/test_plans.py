"""Plan shape: pushdown, pruning, bounded top-n, no Python in the hot path."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as E
from data_folders import SF_SMALL
from touchline import registry


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def query_plan(spark, key):
    return plan_text(E.queries()[key](spark, SF_SMALL))


def test_league_table_filters_reach_the_scans(spark):
    text = query_plan(spark, "league_table")
    assert "EqualTo(r_name,EUROPE)" in text
    assert "= 1997" in text  # season predicate evaluated right above the orders scan


def test_sales_date_range_is_pushed_into_the_scan(spark):
    text = query_plan(spark, "sales_window")
    assert "GreaterThanOrEqual(l_shipdate," in text and "LessThan(l_shipdate," in text
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_top_one_per_role_is_limited_before_the_shuffle(spark):
    text = plan_text(E.queries()["top_minutes_by_role"](spark, SF_SMALL), "simple")
    lines = [ln for ln in text.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning(role" in ln]
    kinds = ["limit" if "WindowGroupLimit" in ln else "exchange" for ln in lines]
    # final limit, the shuffle by role, and a partial limit below it
    assert kinds[:3] == ["limit", "exchange", "limit"]


@pytest.mark.parametrize("key", ["most_colored", "least_colored_ratio", "top_colors_share", "color_signature_count"])
def test_colour_questions_shuffle_images_never_pixels(spark, key):
    text = plan_text(E.queries()[key](spark, SF_SMALL), "simple")
    exchanges = [ln for ln in text.splitlines() if "Exchange hashpartitioning" in ln]
    # any shuffle is keyed by the image (join or per-image counters), never by colour or pixel
    assert all("filename" in ln or "hexcode" in ln for ln in exchanges), exchanges
    assert "partial_count" in text  # pixels are counted map-side, before any shuffle


def test_match_results_use_hash_aggregation(spark):
    text = query_plan(spark, "match_results")
    assert "HashAggregate" in text and "SortAggregate" not in text


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "PythonMapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas", "WindowInPandas", "AggregateInPandas")


def test_no_python_worker_in_any_core_query(spark):
    # model fits and file round trips run jobs before their plan exists
    heavy = {"rf_predict", "nb_predict", "classifier_report", "minmax_scale", "scan_csv", "scan_jsonl", "scan_parquet", "scan_images"}
    for key, query in registry.queries().items():
        if key in heavy:
            continue
        text = plan_text(query(spark, SF_SMALL))
        assert not any(node in text for node in PYTHON_NODES), key


def test_stints_join_length_at_match_grain(spark):
    text = plan_text(E.queries()["player_stints"](spark, SF_SMALL), "simple")
    # the only shuffle joins is keyed by match, below the explode into players
    joins = [ln for ln in text.splitlines() if "Join" in ln and "Broadcast" not in ln]
    assert all("matchId" in ln for ln in joins)


@pytest.mark.parametrize("key", ["team_stats_with_passes", "best_teams"])
def test_best_teams_read_the_line_items_once(spark, key):
    text = plan_text(E.queries()[key](spark, SF_SMALL), "simple")
    assert sum("FileScan" in ln and "l_orderkey" in ln for ln in text.splitlines()) == 1
