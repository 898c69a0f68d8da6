"""Hand-made cases for match results, standings, tables and passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import matches as M
from touchline.operators import passes as P
from touchline.operators import teams as TM
from data_folders import SF_SMALL


def event(match, home, away, event, team, tags, period="1H", time=10.0, comp="L", season="S"):
    return (comp, season, match, None, home, away, event, None, team, None, period, time, tags, None, None)


def events_df(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS)


def test_goal_counted_from_keeper_event_only(spark):
    rows = [
        # A scores against B: scorer event (ignored) and B's keeper event (counted)
        event(1, "A", "B", "Shot", "A", ["Goal"]),
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        # own goal by B's player: the keeper of A concedes, so it is B's goal
        event(1, "A", "B", "Others", "B", ["Goal", "Own goal"]),
        event(1, "A", "B", "Save attempt", "A", ["Goal"]),
        # save without goal, null tags, goalless second match
        event(1, "A", "B", "Save attempt", "A", []),
        event(1, "A", "B", "Save attempt", "B", None),
        event(2, "C", "D", "Pass", "C", ["Accurate"]),
    ]
    res = {r.matchId: (r.homeTeamGoals, r.awayTeamGoals) for r in M.match_results(events_df(spark, rows)).collect()}
    assert res == {1: (1, 1), 2: (0, 0)}


def test_summary_single_pass(spark):
    rows = [
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(1, "A", "B", "Save attempt", "A", ["Goal"]),
        event(2, "C", "D", "Pass", "C", []),
    ]
    s = M.match_summary(M.match_results(events_df(spark, rows))).first()
    assert (s.matches, s.goalless, s.most_goals, s.total_goals) == (2, 1, 3, 3)


def test_summary_of_empty_input(spark):
    s = M.match_summary(M.match_results(events_df(spark, []))).first()
    assert (s.matches, s.goalless, s.most_goals, s.total_goals) == (0, 0, None, 0)


def _fixture_standings(spark):
    from touchline.sources import fixtures as fx

    return M.match_results(fx.events(spark, SF_SMALL))


def test_standings_invariants_and_both_forms_agree(spark):
    matches = _fixture_standings(spark).cache()
    a = M.season_standings(matches)
    b = M.season_standings_outer(matches)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    per_league = a.groupBy("competition", "season").agg(
        F.sum("wins").alias("w"), F.sum("losses").alias("l"),
        F.sum("goalsScored").alias("gf"), F.sum("goalsConceded").alias("ga"),
    ).collect()
    assert all(r.w == r.l and r.gf == r.ga for r in per_league)
    bad = a.filter(
        (F.col("games") != F.col("wins") + F.col("draws") + F.col("losses"))
        | (F.col("points") != F.col("wins") * 3 + F.col("draws"))
    )
    assert bad.count() == 0
    matches.unpersist()


def test_standings_across_seasons_are_separate(spark):
    rows = [
        event(1, "A", "B", "Save attempt", "B", ["Goal"], season="S1"),
        event(2, "A", "B", "Save attempt", "A", ["Goal"], season="S2"),
    ]
    st = M.season_standings(M.match_results(events_df(spark, rows)))
    got = {(r.season, r.team): (r.games, r.points) for r in st.collect()}
    assert got == {("S1", "A"): (1, 3), ("S1", "B"): (1, 0), ("S2", "A"): (1, 0), ("S2", "B"): (1, 3)}


def test_league_table_order_and_signed_difference(spark):
    rows = [
        # A beats B 2-0, C draws D 0-0, A beats D 1-0; ties on points broken by GD, GF, name
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(2, "C", "D", "Pass", "C", []),
        event(3, "D", "A", "Save attempt", "D", ["Goal"]),
        event(4, "L2", "L3", "Pass", "L2", [], comp="Other"),
    ]
    st = M.season_standings(M.match_results(events_df(spark, rows)))
    table = M.league_table(st, "L", "S").collect()
    assert [r.Team for r in table] == ["A", "C", "D", "B"]
    assert [r.Pos for r in table] == [1, 2, 3, 4]
    assert [r.GD for r in table] == ["+3", "0", "-1", "-2"]
    assert [r.Pts for r in table] == [6, 1, 1, 0]


def test_signed_zero_has_no_plus(spark):
    from touchline.functions.football import signed

    got = spark.range(1).select(
        signed(F.lit(0)).alias("z"), signed(F.lit(5)).alias("p"), signed(F.lit(-5)).alias("n")
    ).first()
    assert (got.z, got.p, got.n) == ("0", "+5", "-5")


def test_pass_ratio_is_mean_of_match_ratios(spark):
    rows = [event(1, "A", "B", "Pass", "A", ["Accurate"])] + [event(2, "A", "C", "Pass", "A", []) for _ in range(3)]
    rows += [event(2, "A", "C", "Pass", "A", ["Accurate"])]
    passes = P.match_passes(events_df(spark, rows))
    ratio = P.season_pass_ratio(passes, "S").filter(F.col("team") == "A").first()
    # match 1: 100 %, match 2: 25 % -> mean 62.5 (ratio of sums would be 40)
    assert ratio.passSuccessRatio == 62.5


def test_worst_passer_ties_broken_by_team(spark):
    rows = [event(1, "B", "A", "Pass", "B", []), event(1, "B", "A", "Pass", "A", [])]
    worst = P.worst_passers(P.match_passes(events_df(spark, rows)), "S").collect()
    assert [(r.competition, r.team, r.passSuccessRatio) for r in worst] == [("L", "A", 0.0)]


def test_one_pass_stats_equal_joined_ones(spark):
    from touchline.sources import fixtures as fx

    rows = [
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(1, "A", "B", "Pass", "A", ["Accurate"]),
        event(1, "A", "B", "Pass", "A", None),
        event(2, "C", "A", "Pass", "A", []),
        event(2, "C", "A", "Pass", None, []),
        event(3, "B", "C", "Pass", "B", [], season="T"),
    ]
    for ev, season in ((events_df(spark, rows), "S"), (fx.events(spark, SF_SMALL), "1997"), (events_df(spark, []), "S")):
        joined = TM.attach_pass_ratio(TM.team_season_stats(M.match_results(ev), season), P.match_passes(ev), season)
        one_pass = TM.season_stats_with_passes(ev, season)
        assert sorted(one_pass.columns) == sorted(joined.columns)
        one_pass = one_pass.select(joined.columns)
        shown = lambda df: sorted(map(tuple, df.withColumn("passRatioRaw", F.round("passRatioRaw", 6)).collect()), key=str)
        assert shown(one_pass) == shown(joined)


def test_best_teams_position_is_league_position(spark):
    rows = [
        event(1, "A", "B", "Save attempt", "B", ["Goal"]),
        event(2, "C", "A", "Save attempt", "A", ["Goal"]),
        event(3, "B", "C", "Pass", "B", []),
    ]
    ev = events_df(spark, rows)
    stats = TM.attach_pass_ratio(TM.team_season_stats(M.match_results(ev), "S"), P.match_passes(ev), "S")
    best = TM.best_teams(stats, 2).collect()
    # C: win + draw = 4 points in 2 games; A: win + loss = 3; B: 1
    assert [(r.Team, r.Pos) for r in best] == [("C", 1), ("A", 2)]
    assert [r.Avg for r in best] == [2.0, 1.5]
    assert best[0].GD == "+1" and best[0].PassRatio is None
