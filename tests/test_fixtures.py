"""The derived test views reproduce the figures recorded in FIXTURES.md."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from data_folders import SF_MID, SF_SMALL
from touchline.operators import matches as M
from touchline.sources import fixtures as fx


@pytest.mark.parametrize("sf,events,matches,goals", [(SF_SMALL, 7500, 1500, 975), (SF_MID, 75000, 15000, 9970)])
def test_event_match_and_goal_counts(spark, sf, events, matches, goals):
    ev = fx.events(spark, sf)
    summary = M.match_summary(M.match_results(ev)).first()
    assert ev.count() == events
    assert (summary.matches, summary.total_goals) == (matches, goals)


def test_standings_rows_and_no_ties_in_table_order(spark):
    st = M.season_standings(M.match_results(fx.events(spark, SF_MID)))
    assert st.count() == 175
    keys = st.groupBy("competition", "season", "points", (F.col("goalsScored") - F.col("goalsConceded")).alias("gd"), "goalsScored")
    assert keys.count().filter(F.col("count") > 1).count() == 0


@pytest.mark.parametrize("sf,brand", [(SF_SMALL, "Brand#13"), (SF_MID, "Brand#2")])
def test_best_publisher(spark, sf, brand):
    assert E.queries()["sales_top_publisher"](spark, sf).first().publisher == brand


def test_signature_and_top_minutes(spark):
    sig = E.queries()["color_signature_count"](spark, SF_MID).first()
    assert (sig.signature, sig.images) == ("Green-Blue-Purple", 177)
    top = {(r.role, r.player, r.minutes) for r in E.queries()["top_minutes_by_role"](spark, SF_MID).collect()}
    # player ids 311, 304, 308, 301 are slots 11, 4, 8, 1 of nation 3
    assert top == {
        ("Forward", "P11 NATION_3", 19570),
        ("Defender", "P4 NATION_3", 19317),
        ("Midfielder", "P8 NATION_3", 19257),
        ("Goalkeeper", "P1 NATION_3", 19137),
    }


def test_cyclic_metrics_on_fixed_predictions(spark):
    m = E.queries()["eval_cyclic"](spark, SF_MID).first()
    assert (m.correct, m.within_one, m.within_two) == (20.0, 60.0, 100.0)
