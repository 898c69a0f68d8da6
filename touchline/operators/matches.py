"""Match results, season standings and league tables from event rows.

Shuffle budget of the league-table job: one aggregation shuffle keyed by match
(partial aggregation first, so a hot match is combined map-side), one keyed by
team, and one tiny window over the finished standings. A filter on
competition/season is pushed through both aggregations into the event scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.football import away_goal, home_goal, signed
from touchline.plans.topn import rank_within

MATCH_KEYS = ["matchId", "competition", "season", "homeTeam", "awayTeam"]
STANDING_KEYS = ["competition", "season", "team"]


def goal_flags(events: DataFrame) -> DataFrame:
    """Add boolean ``homeGoal`` / ``awayGoal`` columns to every event."""
    return events.withColumns({"homeGoal": home_goal(), "awayGoal": away_goal()})


def match_results(events: DataFrame) -> DataFrame:
    """One row per match with the goals of each side; goalless matches stay (0:0).

    The match attributes are grouping keys rather than ``first(...)``
    aggregates: they are functionally dependent on ``matchId``, and keeping
    them as keys lets Spark use hash aggregation and push filters on them
    below the aggregate.
    """
    return (
        events.select(*MATCH_KEYS, home_goal().alias("h"), away_goal().alias("a"))
        .groupBy(*MATCH_KEYS)
        .agg(F.count_if("h").alias("homeTeamGoals"), F.count_if("a").alias("awayTeamGoals"))
    )


def match_summary(matches: DataFrame) -> DataFrame:
    """Match count, goalless matches, most goals in one match and all goals, in one pass."""
    total = F.col("homeTeamGoals") + F.col("awayTeamGoals")
    return matches.agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(total == 0).alias("goalless"),
        F.max(total).alias("most_goals"),
        F.coalesce(F.sum(total), F.lit(0)).cast("long").alias("total_goals"),
    )


def _side(team: str, opponent: str, gf: str, ga: str, *more: Column) -> Column:
    goals_for, goals_against = F.col(gf), F.col(ga)
    return F.struct(
        F.col(team).alias("team"),
        F.col(opponent).alias("opponent"),
        goals_for.alias("GF"),
        goals_against.alias("GA"),
        (goals_for > goals_against).cast("int").alias("W"),
        (goals_for == goals_against).cast("int").alias("D"),
        (goals_for < goals_against).cast("int").alias("L"),
        F.when(goals_for > goals_against, 3).when(goals_for == goals_against, 1).otherwise(0).alias("points"),
        *more,
    )


def team_match_rows(matches: DataFrame, more: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Two rows per match, one from each team's point of view (single scan).
    ``more`` names further columns: name -> (home side's column, away side's)."""
    more = more or {}
    views = F.array(
        _side("homeTeam", "awayTeam", "homeTeamGoals", "awayTeamGoals", *[F.col(h).alias(n) for n, (h, _) in more.items()]),
        _side("awayTeam", "homeTeam", "awayTeamGoals", "homeTeamGoals", *[F.col(a).alias(n) for n, (_, a) in more.items()]),
    )
    return matches.select("matchId", "competition", "season", F.inline(views))


def _standing_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("games"),
        F.sum("W").alias("wins"),
        F.sum("D").alias("draws"),
        F.sum("L").alias("losses"),
        F.sum("GF").alias("goalsScored"),
        F.sum("GA").alias("goalsConceded"),
        F.sum("points").alias("points"),
    ]


def season_standings(matches: DataFrame) -> DataFrame:
    """Per competition, season and team: games, W/D/L, goals and points (3/1/0)."""
    return team_match_rows(matches).groupBy(*STANDING_KEYS).agg(*_standing_measures())


def season_standings_outer(matches: DataFrame) -> DataFrame:
    """The same standings from a home-side and an away-side aggregate joined
    with a full outer join (a team may have only home or only away games)."""

    def one_side(team: str, gf: str, ga: str, prefix: str) -> DataFrame:
        goals_for, goals_against = F.col(gf), F.col(ga)
        return (
            matches.groupBy("competition", "season", F.col(team).alias("team"))
            .agg(
                F.count(F.lit(1)).alias(f"{prefix}games"),
                F.count_if(goals_for > goals_against).alias(f"{prefix}wins"),
                F.count_if(goals_for == goals_against).alias(f"{prefix}draws"),
                F.count_if(goals_for < goals_against).alias(f"{prefix}losses"),
                F.sum(goals_for).alias(f"{prefix}goalsScored"),
                F.sum(goals_against).alias(f"{prefix}goalsConceded"),
            )
        )

    home = one_side("homeTeam", "homeTeamGoals", "awayTeamGoals", "h_")
    away = one_side("awayTeam", "awayTeamGoals", "homeTeamGoals", "a_")
    joined = home.join(away, STANDING_KEYS, "full_outer")

    def both(name: str) -> Column:
        return F.coalesce(F.col(f"h_{name}"), F.lit(0)) + F.coalesce(F.col(f"a_{name}"), F.lit(0))

    return joined.select(
        *STANDING_KEYS,
        both("games").alias("games"),
        both("wins").alias("wins"),
        both("draws").alias("draws"),
        both("losses").alias("losses"),
        both("goalsScored").alias("goalsScored"),
        both("goalsConceded").alias("goalsConceded"),
        (both("wins") * 3 + both("draws")).alias("points"),
    )


def classification_order() -> list[Column]:
    """Points, then goal difference, then goals scored; team name makes it total."""
    return [
        F.col("points").desc(),
        (F.col("goalsScored") - F.col("goalsConceded")).desc(),
        F.col("goalsScored").desc(),
        F.col("team").asc(),
    ]


def league_tables(standings: DataFrame) -> DataFrame:
    """Every league table at once: standings plus ``Pos`` within competition and season."""
    return rank_within(standings, ["competition", "season"], classification_order(), "Pos")


def league_table(standings: DataFrame, competition: str, season: str) -> DataFrame:
    """The final table of one league and season, ordered by position."""
    one = standings.filter((F.col("competition") == competition) & (F.col("season") == season))
    gd = F.col("goalsScored") - F.col("goalsConceded")
    return (
        league_tables(one)
        .select(
            "Pos",
            F.col("team").alias("Team"),
            F.col("games").alias("Pld"),
            F.col("wins").alias("W"),
            F.col("draws").alias("D"),
            F.col("losses").alias("L"),
            F.col("goalsScored").alias("GF"),
            F.col("goalsConceded").alias("GA"),
            signed(gd).alias("GD"),
            F.col("points").alias("Pts"),
        )
        .orderBy("Pos")
    )
