"""Playing time and plus-minus on hand-made matches (rules of the task text)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import players as PL
from data_folders import SF_SMALL


def team(name, base, subs=(None, None, None)):
    lineup = [base + i for i in range(1, 12)]
    bench = [base + 12, base + 13, base + 14]
    return (name, None, lineup, bench, *subs)


def match(mid, home, away, season="S"):
    return (mid, "L", season, None, None, dt.date(2020, 1, 1), "Played", home, away)


def matches_df(spark, rows):
    return spark.createDataFrame(rows, schemas.MATCHES)


def ev(mid, period, seconds, event="Pass", team="H", tags=(), season="S"):
    return ("L", season, mid, None, "H", "A", event, None, team, None, period, float(seconds), list(tags), None, None)


def events_df(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS)


def goal_for(scorer, mid, period, seconds):
    keeper = "A" if scorer == "H" else "H"
    return ev(mid, period, seconds, "Save attempt", keeper, ["Goal"])


def stints_of(spark, mrows, erows):
    events = events_df(spark, erows)
    return PL.player_stints(matches_df(spark, mrows), PL.match_length(events)), events


def test_match_length_rounds_last_second_half_event_up(spark):
    e = events_df(spark, [ev(1, "1H", 2900), ev(1, "2H", 2845), ev(1, "2H", 100)])
    assert PL.match_length(e).first().matchLength == 93


def test_minutes_starters_taken_off_and_players_on_and_off(spark):
    home = team("H", 100, ((112, 105, 60), None, (114, 112, 80)))  # 112 on at 60, off at 80
    away = team("A", 200)
    stints, _ = stints_of(spark, [match(1, home, away)], [ev(1, "2H", 2845)])
    got = {r.playerId: (r.startMinute, r.endMinute, r.minutes) for r in stints.collect()}
    assert got[105] == (0, 60, 60)  # starter taken off keeps only his own minutes
    assert got[112] == (60, 80, 20)
    assert got[114] == (80, 93, 13)
    assert got[101] == (0, 93, 93)
    assert 113 not in got  # unused bench player is not involved
    total = stints.agg(F.sum("minutes")).first()[0]
    assert total == 22 * 93


def test_match_without_second_half_events_lasts_90(spark):
    stints, _ = stints_of(spark, [match(1, team("H", 100), team("A", 200))], [ev(1, "1H", 60)])
    assert {r.endMinute for r in stints.collect()} == {90}


def test_goal_at_substitution_second_counts_for_replacement(spark):
    # substitution at minute 80 = second 2100 of the second half
    home = team("H", 100, ((112, 105, 80), None, None))
    events = [goal_for("A", 1, "2H", 2100.0), goal_for("H", 1, "2H", 2099.0), ev(1, "2H", 2845)]
    stints, e = stints_of(spark, [match(1, home, team("A", 200))], events)
    pm = {r.playerId: r.plusMinus for r in PL.plus_minus(stints, PL.goal_team(e)).collect()}
    assert pm[112] == -1  # on the pitch from second 2100.0 on
    assert pm[105] == 1  # off before the away goal, on for the home goal at 2099
    assert pm[101] == 0 and pm[201] == 0


def test_first_half_stoppage_time_goal(spark):
    # home changes at 45 (second half) and at 44 (first half); goal in 1H stoppage time
    home = team("H", 100, ((112, 105, 45), (113, 106, 44), None))
    events = [goal_for("H", 1, "1H", 2750.0), ev(1, "2H", 2845)]
    stints, e = stints_of(spark, [match(1, home, team("A", 200))], events)
    pm = {r.playerId: r.plusMinus for r in PL.plus_minus(stints, PL.goal_team(e)).collect()}
    assert pm[105] == 1  # taken off at 45: played the whole first half
    assert 112 not in pm  # came on at 45: second half only
    assert pm[113] == 1  # came on at 44, still the first half
    assert 106 not in pm  # went off at minute 44, before the goal
    assert pm[201] == -1


def test_plus_minus_sums_to_zero_per_match_on_fixture(spark):
    from touchline.sources import fixtures as fx

    stints = PL.player_stints(fx.matches(spark, SF_SMALL), PL.match_length(fx.events(spark, SF_SMALL)))
    events = PL.plus_minus_events(stints, PL.goal_team(fx.events(spark, SF_SMALL)))
    per_match = events.groupBy("matchId").agg(F.sum("delta").alias("s"))
    assert per_match.filter(F.col("s") != 0).count() == 0
    minutes = stints.groupBy("matchId").agg(F.sum("minutes").alias("m"), F.max("endMinute").alias("len"))
    assert minutes.filter(F.col("m") != 22 * F.col("len")).count() == 0
    assert stints.filter(F.col("minutes") < 0).count() == 0


def test_substitution_rows_skip_unused_slots(spark):
    home = team("H", 100, ((112, 105, 60), None, None))
    subs = PL.substitution_rows(matches_df(spark, [match(1, home, team("A", 200))])).collect()
    assert [(r.team, r.playerIn, r.playerOut, r.minute) for r in subs] == [("H", 112, 105, 60)]
    lineup = PL.lineup_rows(matches_df(spark, [match(1, home, team("A", 200))]))
    assert lineup.count() == 22


def test_top_minutes_by_role_and_plus_minus_above(spark):
    from touchline.sources import fixtures as fx

    events = fx.events(spark, SF_SMALL)
    stints = PL.player_stints(fx.matches(spark, SF_SMALL), PL.match_length(events))
    top = PL.top_minutes_by_role(stints, fx.players(spark, SF_SMALL), "1997").collect()
    assert sorted(r.role for r in top) == ["Defender", "Forward", "Goalkeeper", "Midfielder"]
    above = PL.plus_minus_above(fx.matches(spark, SF_SMALL), PL.match_length(events), PL.goal_team(events), fx.players(spark, SF_SMALL), None, 20).collect()
    assert above and all(r.plusMinus > 20 for r in above)
    assert [r.plusMinus for r in above] == sorted((r.plusMinus for r in above), reverse=True)


def test_balances_equal_the_goals_inside_each_interval(spark):
    import random

    rng = random.Random(4)

    def subs(base):
        made = []
        for k in range(3):
            minute = rng.choice([0, 10, 44, 45, 46, 60, 60, 90])
            made.append(None if rng.random() < 0.3 else (base + 12 + k, base + rng.choice([1, 2, 12]), minute))
        return made

    mrows = [match(m, team("H", 100, subs(100)), team("A", 200, subs(200))) for m in range(12)]
    mrows.append(mrows[0])  # a repeated row: its intervals come twice, its goals count once in each
    erows = []
    for m in range(12):
        erows += [goal_for(rng.choice("HA"), m, rng.choice(["1H", "2H"]), rng.choice([0, 599.5, 600, 2640, 2700, 2899, 0, 60, 900])) for _ in range(rng.randint(0, 9))]
    events = events_df(spark, erows)
    matches, lengths, goals = matches_df(spark, mrows), PL.match_length(events), PL.goal_team(events)
    key = lambda r: (r.matchId, r.team, r.playerId)
    pairs = {}
    for r in PL.plus_minus_events(PL.player_stints(matches, lengths), goals).collect():
        total, n = pairs.get(key(r), (0, 0))
        pairs[key(r)] = (total + r.delta, n + 1)
    sums = {}
    for r in PL.stint_balances(matches, lengths, goals).collect():
        total, n = sums.get(key(r), (0, 0))
        sums[key(r)] = (total + r.plusMinus, n + r.goals)
    assert {k: v for k, v in sums.items() if v[1]} == pairs and len(pairs) > 200
    assert PL.stint_balances(matches.limit(0), lengths, goals).count() == 0


def test_goals_and_stints_do_not_meet_as_rows(spark):
    import contextlib
    import io

    from touchline import registry

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        registry.queries()["plus_minus_above"](spark, SF_SMALL).explain("formatted")
    joins = [line for line in text.getvalue().splitlines() if line.startswith("Join condition")]
    assert all("clock" not in line.lower() for line in joins)


def test_stints_query_and_its_sql_tell_competition_and_season(spark):
    import __spark_entry__ as E
    from check_oracle import duck

    got = E.queries()["player_stints"](spark, SF_SMALL)
    sql = duck(SF_SMALL).sql(E.oracle_sql()["player_stints"])
    assert set(got.columns) == set(sql.columns) == {"matchId", "competition", "season", "team", "playerId", "startMinute", "endMinute", "minutes"}
    assert got.where("competition IS NULL OR season IS NULL").count() == 0
