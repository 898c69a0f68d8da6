"""Playing time and plus-minus from line-ups, substitutions and goal events.

Plan shape:

* ``player_stints`` works on one row per team and match: the line-up array and
  the three substitution structs hold everything needed to build each
  player's [start, end) interval, so each player's row is derived in place
  with plain (code-generated) expressions - no self-join and no shuffle. The
  only join is with the match length, done at match grain before the rows
  multiply.
* ``plus_minus_events`` is an interval join: goals (a handful per match,
  filtered at the scan) equi-joined to stints on ``matchId`` with the range
  condition as the join's residual predicate. A hot match is handled by AQE's
  skew-join split; every later step is an aggregation with map-side combine.
* ``stint_balances`` needs no such pairs: goals are counted into the phases
  between a match's line-up changes, and a stint's value is the difference of
  its team's running balance at two changes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.football import (
    SECOND_HALF,
    away_goal,
    event_clock,
    home_goal,
    is_goal,
    substitution_clock,
)
from touchline.plans.topn import top_n_per_group

DEFAULT_MATCH_MINUTES = 90
FIRST_HALF_MINUTES = 45
SUBSTITUTIONS = ("substitution1", "substitution2", "substitution3")


def match_length(events: DataFrame) -> DataFrame:
    """45 + the last second-half event rounded up to a whole minute, per match."""
    return (
        events.filter(F.col("eventPeriod") == SECOND_HALF)
        .groupBy("matchId")
        .agg((F.ceil(F.max("eventTime") / 60) + FIRST_HALF_MINUTES).alias("matchLength"))
    )


def team_sides(matches: DataFrame) -> DataFrame:
    """One row per match and team with that team's struct as ``data``."""
    return matches.select(
        "matchId",
        "competition",
        "season",
        F.inline(
            F.array(
                F.struct(F.col("homeTeamData.team").alias("team"), F.col("homeTeamData").alias("data")),
                F.struct(F.col("awayTeamData.team").alias("team"), F.col("awayTeamData").alias("data")),
            )
        ),
    )


def _used_substitutions() -> Column:
    subs = F.array(*[F.col(f"data.{s}") for s in SUBSTITUTIONS])
    return F.filter(subs, lambda s: s.isNotNull())


def lineup_rows(matches: DataFrame) -> DataFrame:
    """One row per starting player: match, team, player, start minute 0."""
    return team_sides(matches).select(
        "matchId",
        "competition",
        "season",
        "team",
        F.explode("data.lineup").alias("playerId"),
        F.lit(0).alias("startMinute"),
    )


def substitution_rows(matches: DataFrame) -> DataFrame:
    """One row per substitution actually made: team, player in, player out, minute."""
    return team_sides(matches).select(
        "matchId", "competition", "season", "team", F.inline(_used_substitutions())
    )


def _minute_of(field: str, player: Column) -> Column:
    """Minute of the substitution whose ``field`` (playerIn / playerOut) is
    ``player``; null if none. A plain expression over the three struct slots,
    so it is compiled by whole-stage codegen (no lambda)."""
    return F.least(
        *[F.when(F.col(f"data.{s}.{field}") == player, F.col(f"data.{s}.minute")) for s in SUBSTITUTIONS]
    )


def player_stints(matches: DataFrame, lengths: DataFrame) -> DataFrame:
    """One [start, end) interval per player and match.

    Minutes use the plain match clock: starters begin at 0, a substitution
    happens at the start of its minute, a player not taken off plays to the
    match length. A match without second-half events gets 90 minutes, and
    bounds are clamped to the length. ``startClock`` / ``endClock`` give the
    same interval on the half-aware clock used for goals (``endClock`` null =
    on the pitch until the end).

    The length is joined at match grain (one row per match on both sides),
    before the rows multiply into ~28 players per match, so that join shuffles
    matches, not stints; the explode itself is a narrow step.
    """
    return _stints(matches, lengths)


def _stints(matches: DataFrame, lengths: DataFrame, carried: Sequence[str] = (), of_side: dict[str, Column] | None = None) -> DataFrame:
    """``player_stints`` with the columns ``carried`` of the matches and columns
    computed from them once a team and match (``data.team`` is the team)."""
    with_length = matches.join(lengths, "matchId", "left").withColumn(
        "matchLength", F.coalesce(F.col("matchLength"), F.lit(DEFAULT_MATCH_MINUTES).cast("long"))
    )

    def side(data: str) -> Column:
        return F.struct(
            F.col(f"{data}.team").alias("team"),
            # a side without a line-up still has its substitutes
            F.coalesce(F.col(f"{data}.lineup"), F.array()).alias("lineup"),
            *[F.col(f"{data}.{sub}").alias(sub) for sub in SUBSTITUTIONS],
        )

    sides = with_length.select(
        "matchId",
        "competition",
        "season",
        "matchLength",
        *carried,
        F.explode(F.array(side("homeTeamData"), side("awayTeamData"))).alias("data"),
    )
    extra = [*carried, *(of_side or {})]
    if of_side:
        sides = sides.withColumns(of_side)
    entered = F.array_compact(F.array(*[F.col(f"data.{s}.playerIn") for s in SUBSTITUTIONS]))
    played = sides.select(
        "matchId",
        "competition",
        "season",
        "matchLength",
        "data",
        *extra,
        F.explode(F.array_distinct(F.concat(F.col("data.lineup"), entered))).alias("playerId"),
    )
    player = F.col("playerId")
    start_minute = (
        F.when(F.array_contains("data.lineup", player), F.lit(0)).otherwise(_minute_of("playerIn", player))
    )
    out_minute = _minute_of("playerOut", player)
    length = F.col("matchLength")
    end = F.least(F.coalesce(out_minute.cast("long"), length), length)
    return played.select(
        "matchId",
        "competition",
        "season",
        F.col("data.team").alias("team"),
        "playerId",
        start_minute.alias("startMinute"),
        end.alias("endMinute"),
        (end - F.least(start_minute.cast("long"), length)).alias("minutes"),
        substitution_clock(start_minute).alias("startClock"),
        F.when(out_minute.isNotNull(), substitution_clock(out_minute)).alias("endClock"),
        *extra,
    )


def player_minutes(stints: DataFrame) -> DataFrame:
    """Total minutes per player and season."""
    return stints.groupBy("season", "playerId").agg(F.sum("minutes").alias("minutes"))


def full_name() -> Column:
    return F.concat_ws(" ", F.col("firstName"), F.col("lastName"))


def top_minutes_by_role(stints: DataFrame, players: DataFrame, season: str) -> DataFrame:
    """The player with most minutes in ``season`` for each role (ties: lower id).

    The per-role top-1 window plans as a partial ``WindowGroupLimit`` before
    the shuffle, so only one candidate per role leaves each map task even
    though there are just four roles.
    """
    minutes = player_minutes(stints.filter(F.col("season") == season))
    with_role = minutes.join(players.select("playerId", "role", "firstName", "lastName", "birthArea"), "playerId")
    best = top_n_per_group(with_role, ["role"], [F.col("minutes").desc(), F.col("playerId").asc()], 1)
    return best.orderBy(F.col("minutes").desc(), "role").select(
        "role", full_name().alias("player"), "birthArea", "minutes"
    )


def goal_team(events: DataFrame) -> DataFrame:
    """One row per goal with the scoring team and the half-aware clock."""
    scorer = F.when(home_goal(), F.col("homeTeam")).when(away_goal(), F.col("awayTeam"))
    return (
        # goal events first: a predicate on the event's own columns reaches the scan
        events.filter(is_goal())
        .select(
            "matchId",
            "competition",
            "season",
            "eventId",
            "eventPeriod",
            "eventTime",
            scorer.alias("goalTeam"),
        )
        .filter(F.col("goalTeam").isNotNull())
        .withColumn("clock", event_clock(F.col("eventPeriod"), F.col("eventTime")))
    )


def plus_minus_events(stints: DataFrame, goals: DataFrame) -> DataFrame:
    """+1 / -1 for every player on the pitch at each goal (interval join)."""
    g = goals.select(
        F.col("matchId").alias("goalMatchId"), "eventId", "eventPeriod", "eventTime", "goalTeam", "clock"
    )
    s = stints.select("matchId", "season", "team", "playerId", "startClock", "endClock")
    # Null-safe bounds: no end = on the pitch to the final whistle; an unknown
    # start never matches. Written with coalesce (never null), so the
    # optimizer infers no extra not-null filter on the stints side - such a
    # filter lands right above the player explode and re-evaluates the whole
    # start-minute expression there (measured 5x slower at sf0.1).
    never = F.lit(float("inf"))
    on_pitch = (
        (F.col("matchId") == F.col("goalMatchId"))
        & (F.col("clock") >= F.coalesce(F.col("startClock"), never))
        & (F.col("clock") < F.coalesce(F.col("endClock"), never))
    )
    return s.join(g, on_pitch).select(
        "matchId",
        "season",
        "playerId",
        "team",
        "eventId",
        "eventPeriod",
        "eventTime",
        F.when(F.col("team") == F.col("goalTeam"), 1).otherwise(-1).alias("delta"),
    )


def plus_minus(stints: DataFrame, goals: DataFrame) -> DataFrame:
    """Total plus-minus per player and season."""
    return plus_minus_events(stints, goals).groupBy("season", "playerId").agg(F.sum("delta").alias("plusMinus"))


def change_clocks() -> Column:
    """The sorted clocks at which a match's line-ups change (0 and the
    substitutions, seven at most)."""
    minutes = [F.col(f"{d}.{s}.minute") for d in ("homeTeamData", "awayTeamData") for s in SUBSTITUTIONS]
    clocks = F.array_compact(F.array(F.lit(0.0), *[substitution_clock(m) for m in minutes]))
    return F.array_sort(F.array_distinct(clocks))


def goal_tallies(matches: DataFrame, goals: DataFrame) -> DataFrame:
    """One row per match with goals: ``changes`` and the goals of each team in
    each of the phases between them (phase p: p changes have happened).

    A goal meets its match's changes once and is counted map-side into its
    phase, so a match with very many goals leaves a few rows a task.
    """
    changing = matches.select("matchId", change_clocks().alias("changes")).distinct()  # a repeated row counts goals once
    phased = goals.select("matchId", "goalTeam", "clock").join(changing, "matchId").select(
        "matchId", "changes", "goalTeam", F.size(F.filter("changes", lambda c: c <= F.col("clock"))).alias("phase")
    )
    counted = phased.groupBy("matchId", "changes", "goalTeam", "phase").agg(F.count(F.lit(1)).alias("goals"))
    return counted.groupBy("matchId", "changes").agg(F.collect_list(F.struct("goalTeam", "phase", "goals")).alias("tallies"))


def stint_balances(matches: DataFrame, lengths: DataFrame, goals: DataFrame) -> DataFrame:
    """``player_stints`` with ``plusMinus`` (goals for minus goals against while
    the player was on the pitch) and ``goals`` (all of them).

    Every team has a running balance of its match: entry p is the balance before
    the p-th change. A stint's value is the balance at its end minus the one at
    its start, two look-ups - goals and stints never meet as rows.
    """
    tallied = matches.withColumn("changes", change_clocks()).join(goal_tallies(matches, goals), ["matchId", "changes"], "left")

    def running(weight: Callable[[Column], Column]) -> Column:
        upto = lambda p: F.aggregate(
            F.filter("tallies", lambda t: t["phase"] < p), F.lit(0).cast("long"), lambda acc, t: acc + weight(t)
        )
        return F.when(F.col("tallies").isNotNull(), F.transform(F.sequence(F.lit(0), F.size("changes") + 1), upto))

    own = lambda t: F.when(t["goalTeam"] == F.col("data.team"), t["goals"]).otherwise(-t["goals"])
    stints = _stints(tallied, lengths, ["changes", "tallies"], {"balance": running(own), "scored": running(lambda t: t["goals"])})
    start = F.array_position("changes", F.col("startClock")).cast("int")
    end = F.when(F.col("endClock").isNull(), F.size("changes") + 1).otherwise(F.array_position("changes", F.col("endClock")).cast("int"))
    # an interval that ends before it begins holds no goal
    held = lambda c: F.when(end > start, F.get(c, end) - F.get(c, start)).otherwise(F.lit(0).cast("long"))
    value = lambda c: F.when(F.col("startClock").isNotNull() & F.col(c).isNotNull(), held(F.col(c))).otherwise(F.lit(0).cast("long"))
    return stints.withColumns({"plusMinus": value("balance"), "goals": value("scored")}).drop("changes", "tallies", "balance", "scored")


def plus_minus_above(
    matches: DataFrame, lengths: DataFrame, goals: DataFrame, players: DataFrame, season: str | None, threshold: int
) -> DataFrame:
    """Players whose plus-minus (in ``season``, or over all data when None)
    is strictly greater than ``threshold``; players without a goal scored while
    they were on the pitch have none."""
    if season is not None:
        matches = matches.filter(F.col("season") == season)
        goals = goals.filter(F.col("season") == season)
    totals = stint_balances(matches, lengths, goals).groupBy("playerId").agg(F.sum("plusMinus").alias("plusMinus"), F.sum("goals").alias("goals"))
    return (
        totals.filter((F.col("plusMinus") > threshold) & (F.col("goals") > 0))
        .join(players, "playerId")
        .orderBy(F.col("plusMinus").desc(), "playerId")
        .select(full_name().alias("player"), "birthArea", "role", "plusMinus")
    )
