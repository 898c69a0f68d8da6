"""Passing statistics per team and match, season ratios and worst passers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.football import ACCURATE_TAG, PASS
from touchline.plans.topn import top_n_per_group

PASS_KEYS = ["matchId", "competition", "season", "team"]


def match_passes(events: DataFrame) -> DataFrame:
    """Per match and team: attempted passes and passes tagged ``Accurate``.

    The ``event = 'Pass'`` filter is applied before the aggregation and is
    pushed into the event scan.
    """
    return (
        events.filter(F.col("event") == PASS)
        .select(
            "matchId",
            "competition",
            "season",
            F.col("eventTeam").alias("team"),
            F.array_contains("tags", ACCURATE_TAG).alias("accurate"),
        )
        .groupBy(*PASS_KEYS)
        .agg(F.count(F.lit(1)).alias("totalPasses"), F.count_if("accurate").alias("successfulPasses"))
    )


def pass_thresholds(passes: DataFrame, total_above: int, successful_above: int) -> DataFrame:
    """Row count and the rows strictly above each threshold, in one aggregation."""
    return passes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("totalPasses") > total_above).alias("high_total"),
        F.count_if(F.col("successfulPasses") > successful_above).alias("high_successful"),
    )


def match_ratio() -> Column:
    """Successful share of one match in percent; null (not an error) for zero attempts."""
    return F.try_divide(F.col("successfulPasses"), F.col("totalPasses")) * 100


def season_ratio_raw(passes: DataFrame, season: str | None = None) -> DataFrame:
    """Unrounded mean of per-match ratios per competition, season and team.

    The mean of ratios (not the ratio of sums) is what is asked for. Ranking
    uses this unrounded value; rounding happens only on output.
    """
    rows = passes if season is None else passes.filter(F.col("season") == season)
    return rows.groupBy("competition", "season", "team").agg(F.avg(match_ratio()).alias("ratio"))


def season_pass_ratio(passes: DataFrame, season: str | None = None) -> DataFrame:
    """``passSuccessRatio``: the season mean in percent, rounded to two decimals."""
    return season_ratio_raw(passes, season).select(
        "competition", "season", "team", F.round("ratio", 2).alias("passSuccessRatio")
    )


def worst_passers(passes: DataFrame, season: str) -> DataFrame:
    """The team with the lowest mean ratio in each competition, lowest first."""
    lowest = top_n_per_group(
        season_ratio_raw(passes, season), ["competition"], [F.col("ratio").asc(), F.col("team").asc()], 1
    )
    return lowest.orderBy("ratio", "competition").select(
        "competition", "team", F.round("ratio", 2).alias("passSuccessRatio")
    )
