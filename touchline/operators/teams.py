"""Best teams by point average, with league position and pass ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.football import ACCURATE_TAG, PASS, away_goal, home_goal, signed
from touchline.operators.matches import MATCH_KEYS, team_match_rows
from touchline.operators.passes import match_ratio, season_ratio_raw
from touchline.plans.topn import rank_within, top_n_per_group

LEAGUE = ["competition", "season"]


def team_season_stats(matches: DataFrame, season: str) -> DataFrame:
    """Pld, W, D, L, GF, GA, Pts, GD and Avg (points per match, 2 decimals) per team."""
    return _season_totals(team_match_rows(matches).filter(F.col("season") == season))


def _season_totals(rows: DataFrame, *more: Column) -> DataFrame:
    stats = rows.groupBy("competition", "season", "team").agg(
        F.count(F.lit(1)).alias("Pld"),
        F.sum("W").alias("W"),
        F.sum("D").alias("D"),
        F.sum("L").alias("L"),
        F.sum("GF").alias("GF"),
        F.sum("GA").alias("GA"),
        *more,
    )
    stats = stats.withColumns({"Pts": F.col("W") * 3 + F.col("D"), "GD": F.col("GF") - F.col("GA")})
    return stats.withColumn("Avg", F.round(_point_average(), 2))


def season_stats_with_passes(events: DataFrame, season: str) -> DataFrame:
    """``team_season_stats`` with ``passRatioRaw``, the unrounded mean of the
    team's match ratios (null without passes), in one pass over the events: one
    aggregation by match, one by team, no join. Passes count for the two teams
    of the match they are recorded in."""
    attempt = F.col("event") == PASS
    accurate = attempt & F.array_contains("tags", ACCURATE_TAG)
    by = lambda side: F.col("eventTeam") == F.col(side)
    matches = (
        events.filter(F.col("season") == season)
        .groupBy(*MATCH_KEYS)
        .agg(
            F.count_if(home_goal()).alias("homeTeamGoals"),
            F.count_if(away_goal()).alias("awayTeamGoals"),
            F.count_if(attempt & by("homeTeam")).alias("homePasses"),
            F.count_if(attempt & by("awayTeam")).alias("awayPasses"),
            F.count_if(accurate & by("homeTeam")).alias("homeAccurate"),
            F.count_if(accurate & by("awayTeam")).alias("awayAccurate"),
        )
    )
    sides = {"totalPasses": ("homePasses", "awayPasses"), "successfulPasses": ("homeAccurate", "awayAccurate")}
    return _season_totals(team_match_rows(matches, sides), F.avg(match_ratio()).alias("passRatioRaw"))


def _point_average() -> Column:
    return F.try_divide(F.col("Pts"), F.col("Pld"))


def attach_pass_ratio(stats: DataFrame, passes: DataFrame, season: str) -> DataFrame:
    """Left join of the season pass ratio; teams without passes keep a null ratio.

    Both sides hold one row per team and season, so the join is small after
    the two aggregations whatever the size of the event data.
    """
    ratio = season_ratio_raw(passes, season).withColumnRenamed("ratio", "passRatioRaw")
    return stats.join(ratio, ["competition", "season", "team"], "left")


def best_teams(stats_with_passes: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` teams with the highest point average in each league.

    Selection uses the unrounded average (ties: better league position);
    ``Pos`` is the league classification (points, goal difference, goals
    scored, team name), computed over the whole league before selecting.
    """
    positioned = rank_within(
        stats_with_passes,
        LEAGUE,
        [F.col("Pts").desc(), F.col("GD").desc(), F.col("GF").desc(), F.col("team").asc()],
        "Pos",
    )
    chosen = top_n_per_group(positioned, LEAGUE, [_point_average().desc(), F.col("Pos").asc()], n)
    return chosen.orderBy(_point_average().desc(), F.col("competition"), F.col("Pos")).select(
        F.col("team").alias("Team"),
        F.col("competition").alias("League"),
        "Pos",
        "Pld",
        "W",
        "D",
        "L",
        "GF",
        "GA",
        signed(F.col("GD")).alias("GD"),
        "Pts",
        "Avg",
        F.round("passRatioRaw", 2).alias("PassRatio"),
    )
