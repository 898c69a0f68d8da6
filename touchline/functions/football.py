"""Column expressions for football events.

Everything is a built-in expression (no Python UDF), so it stays inside
whole-stage code generation and does not block filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed vocabulary of the event data.
SAVE_ATTEMPT = "Save attempt"
PASS = "Pass"
GOAL_TAG = "Goal"
ACCURATE_TAG = "Accurate"
FIRST_HALF = "1H"
SECOND_HALF = "2H"
HALF_MINUTES = 45
# Offset that puts every second-half instant after every first-half instant
# (stoppage time included) on one comparable axis.
SECOND_HALF_OFFSET = 100_000.0


def _conceded_by(team_col: str) -> Column:
    """A goal is counted from the goalkeeper's event: a save attempt tagged
    ``Goal`` by the conceding team. This also covers own goals, whose scorer
    event would otherwise be credited to the wrong side."""
    return F.coalesce(
        (F.col("event") == SAVE_ATTEMPT)
        & F.array_contains(F.col("tags"), GOAL_TAG)
        & (F.col("eventTeam") == F.col(team_col)),
        F.lit(False),
    )


def home_goal() -> Column:
    """True when the event records a goal for the home team."""
    return _conceded_by("awayTeam")


def away_goal() -> Column:
    """True when the event records a goal for the away team."""
    return _conceded_by("homeTeam")


def is_goal() -> Column:
    return F.coalesce(
        (F.col("event") == SAVE_ATTEMPT) & F.array_contains(F.col("tags"), GOAL_TAG),
        F.lit(False),
    )


def signed(value: Column) -> Column:
    """Integer as text with a leading ``+`` only when positive (``+3``, ``0``, ``-2``)."""
    text = value.cast("string")
    return F.when(value > 0, F.concat(F.lit("+"), text)).otherwise(text)


def event_clock(period: Column, seconds: Column) -> Column:
    """Half-aware instant of an event: first-half seconds, or offset + second-half seconds."""
    return F.when(period == SECOND_HALF, F.lit(SECOND_HALF_OFFSET)).otherwise(F.lit(0.0)) + seconds


def substitution_clock(minute: Column) -> Column:
    """Half-aware instant of a substitution made at the start of ``minute``.

    A change at minute 45 or later belongs to the second half, so a goal in
    first-half stoppage time still counts for the player taken off at 45+ and
    not for the player coming on.
    """
    return F.when(minute < HALF_MINUTES, minute * 60.0).otherwise(
        F.lit(SECOND_HALF_OFFSET) + (minute - HALF_MINUTES) * 60.0
    )
