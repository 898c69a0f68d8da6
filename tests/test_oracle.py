"""Every registered query with an oracle agrees with DuckDB on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from check_oracle import compare, duck
from data_folders import SF_SMALL
from touchline import oracle, registry

ORACLE_KEYS = sorted(oracle.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_key_is_registered():
    assert set(ORACLE_KEYS) == set(registry.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_survey_keys_are_registered():
    expected = {
        "scan_csv", "sales_window", "sales_top_publisher", "sales_missing_count", "sales_yearly_totals",
        "scan_parquet", "goal_flags", "match_results", "match_summary", "team_match_rows",
        "season_standings", "season_standings_outer", "league_table", "match_passes", "pass_thresholds",
        "season_pass_ratio", "worst_passers", "team_season_stats", "team_stats_with_passes", "best_teams",
        "match_length", "lineup_rows", "substitution_rows", "player_stints", "player_minutes",
        "top_minutes_by_role", "goal_team", "plus_minus_events", "plus_minus_above",
        "scan_jsonl", "image_metadata_join", "pixel_hex", "pixel_color", "color_histogram",
        "most_colored", "least_colored_ratio", "top_colors_share", "color_signature_count",
        "most_red_in_group", "calendar_features", "drop_incomplete", "ml_assemble", "minmax_scale",
        "train_test_split", "rf_predict", "nb_predict", "eval_accuracy", "eval_cyclic",
        "eval_true_probability", "classifier_report", "scan_images",
    }
    assert expected <= set(E.queries())


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_matches_duckdb(spark, con, key):
    ok, msg = compare(spark, key, SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Pos", "Team", "Pld", "W", "D", "L", "GF", "GA", "GD", "Pts"]
    assert [r.Pos for r in rows] == list(range(1, len(rows) + 1))
