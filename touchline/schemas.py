"""Explicit schemas of the domain inputs.

Readers always pass a schema: no inference job over the input, and a drifted
file fails loudly instead of silently changing column types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Video-game sales, one row per title. Only the columns the jobs use are
# declared; a CSV with more columns must list them in ``sales_csv_schema``.
SALES = T.StructType(
    [
        T.StructField("publisher", T.StringType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("na_sales", T.DecimalType(18, 2)),
        T.StructField("total_sales", T.DecimalType(18, 2)),
    ]
)

POSITION = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)

# Football events, one row per event in a match.
EVENTS = T.StructType(
    [
        T.StructField("competition", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("matchId", T.LongType()),
        T.StructField("eventId", T.LongType()),
        T.StructField("homeTeam", T.StringType()),
        T.StructField("awayTeam", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("subEvent", T.StringType()),
        T.StructField("eventTeam", T.StringType()),
        T.StructField("eventPlayerId", T.LongType()),
        T.StructField("eventPeriod", T.StringType()),
        T.StructField("eventTime", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("startPosition", POSITION),
        T.StructField("enPosition", POSITION),
    ]
)

SUBSTITUTION = T.StructType(
    [
        T.StructField("playerIn", T.LongType()),
        T.StructField("playerOut", T.LongType()),
        T.StructField("minute", T.IntegerType()),
    ]
)

TEAM_DATA = T.StructType(
    [
        T.StructField("team", T.StringType()),
        T.StructField("coachId", T.LongType()),
        T.StructField("lineup", T.ArrayType(T.LongType())),
        T.StructField("bench", T.ArrayType(T.LongType())),
        T.StructField("substitution1", SUBSTITUTION),
        T.StructField("substitution2", SUBSTITUTION),
        T.StructField("substitution3", SUBSTITUTION),
    ]
)

# One row per match with both teams' line-ups and substitutions.
MATCHES = T.StructType(
    [
        T.StructField("matchId", T.LongType()),
        T.StructField("competition", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("roundId", T.LongType()),
        T.StructField("gameWeek", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("homeTeamData", TEAM_DATA),
        T.StructField("awayTeamData", TEAM_DATA),
    ]
)

PLAYERS = T.StructType(
    [
        T.StructField("playerId", T.LongType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("birthArea", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("foot", T.StringType()),
    ]
)

# The struct produced by Spark's ``image`` data source.
IMAGE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("nChannels", T.IntegerType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)

# Image metadata, JSON lines. Only the attributes the jobs use.
IMAGE_META = T.StructType(
    [
        T.StructField("hexcode", T.StringType()),
        T.StructField("annotation", T.StringType()),
        T.StructField("group", T.StringType()),
    ]
)

# Per-minute sensor series.
SERIES = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("power_tenants", T.DoubleType()),
        T.StructField("power_maintenance", T.DoubleType()),
        T.StructField("power_solar_panels", T.DoubleType()),
        T.StructField("electricity_price", T.DoubleType()),
    ]
)
