"""A key holding most of the rows: results stay whole and correct, work is split."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from touchline.operators import matches as M
from touchline.operators import players as PL


def _final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_match_in_plus_minus_join(spark):
    # match 0 carries 3000 goals, matches 1..99 one goal each
    goals = spark.range(3099).select(
        F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id") - 2999).cast("long").alias("matchId"),
        F.lit("S").alias("season"),
        F.col("id").alias("eventId"),
        F.lit("2H").alias("eventPeriod"),
        (F.col("id") % 2000).cast("double").alias("eventTime"),
        F.when(F.col("id") % 2 == 0, F.lit("H")).otherwise(F.lit("A")).alias("goalTeam"),
    ).withColumn("clock", F.lit(100000.0) + F.col("eventTime"))
    stints = spark.range(100).select(
        F.col("id").cast("long").alias("matchId"), F.explode(F.sequence(F.lit(0), F.lit(21))).alias("slot")
    ).select(
        "matchId",
        F.lit("S").alias("season"),
        F.when(F.col("slot") < 11, F.lit("H")).otherwise(F.lit("A")).alias("team"),
        (F.col("matchId") * 100 + F.col("slot")).alias("playerId"),
        F.lit(0.0).alias("startClock"),
        F.lit(None).cast("double").alias("endClock"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        events = PL.plus_minus_events(stints, goals)
        per_match = {r.matchId: (r.n, r.s) for r in events.groupBy("matchId").agg(F.count(F.lit(1)).alias("n"), F.sum("delta").alias("s")).collect()}
        hot = events.filter(F.col("matchId") == 0)
        hot.collect()
        plan = _final_plan(hot)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # every goal meets all 22 players; each goal sums to zero over both teams
    assert per_match[0] == (3000 * 22, 0)
    assert all(per_match[m] == (22, 0) for m in range(1, 100))
    assert "skew" in plan.lower()


def test_hot_match_in_match_results(spark):
    from touchline import schemas

    rows = [("L", "S", 0, None, "H", "A", "Save attempt", None, "A", None, "1H", 1.0, ["Goal"], None, None)] * 3000
    rows += [("L", "S", m, None, "H", "A", "Pass", None, "H", None, "1H", 1.0, [], None, None) for m in range(1, 100)]
    res = M.match_results(spark.createDataFrame(rows, schemas.EVENTS))
    got = {r.matchId: (r.homeTeamGoals, r.awayTeamGoals) for r in res.collect()}
    assert got[0] == (3000, 0) and len(got) == 100
    plan = _final_plan(res)
    # partial aggregation below the shuffle: the hot match sends one row per map task
    assert plan.index("partial_count") > plan.index("Exchange")
