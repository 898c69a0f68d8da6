"""Independent DuckDB SQL for every registered query.

The views of FIXTURES.md §2 are re-derived here in plain SQL from the raw test
tables (``orders``, ``lineitem``, ...), then each job is written again in SQL.
Nothing is shared with the Spark code except column names, so an agreement
between the two is evidence for both.

Type alignment with Spark: integer sums and counts are cast to BIGINT (DuckDB
widens to HUGEINT), calendar parts to INTEGER, window positions to INTEGER.
"""

from __future__ import annotations

from touchline.oracle_models import model_sql

# name -> (dependencies, SQL body of the CTE)
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], body: str) -> None:
    _VIEWS[name] = (deps, body)


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, then ``body``."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in _VIEWS[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return body
    # views that are large and read more than once are computed once
    how = lambda n: "AS MATERIALIZED" if n in ("f_match_base", "f_subs", "f_length") else "AS"
    ctes = ",\n".join(f"{n} {how(n)} (\n{_VIEWS[n][1]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- fixtures

_view(
    "f_match_base",
    (),
    """
    SELECT o.o_orderkey AS matchId, r.r_name AS competition,
           CAST(year(o.o_orderdate) AS VARCHAR) AS season,
           h.n_name AS homeTeam, a.n_name AS awayTeam,
           c.c_nationkey AS home_nk, a.n_nationkey AS away_nk, o.o_orderdate
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation h ON h.n_nationkey = c.c_nationkey
    JOIN nation a ON a.n_nationkey = (c.c_nationkey + 5 * (1 + o.o_orderkey % 4)) % 25
    JOIN region r ON r.r_regionkey = h.n_regionkey
    """,
)

_view(
    "f_events",
    ("f_match_base",),
    """
    SELECT m.competition, m.season, m.matchId,
           l.l_orderkey * 100 + l.l_linenumber AS eventId,
           m.homeTeam, m.awayTeam,
           CASE WHEN l.l_returnflag = 'R' THEN 'Save attempt' ELSE 'Pass' END AS event,
           CASE WHEN l.l_linestatus = 'O' THEN m.homeTeam ELSE m.awayTeam END AS eventTeam,
           CASE WHEN l.l_tax < 0.04 THEN '1H' ELSE '2H' END AS eventPeriod,
           CAST((l.l_orderkey * 7919 + l.l_linenumber * 104729 + l.l_partkey * 31) % 2900 AS DOUBLE) AS eventTime,
           CASE WHEN l.l_returnflag = 'R' AND l.l_quantity > 25 THEN ['Goal']
                WHEN l.l_returnflag <> 'R' AND l.l_discount < 0.05 THEN ['Accurate']
                ELSE CAST([] AS VARCHAR[]) END AS tags
    FROM lineitem l JOIN f_match_base m ON l.l_orderkey = m.matchId
    UNION ALL
    SELECT competition, season, matchId, CAST(NULL AS BIGINT), homeTeam, awayTeam,
           'Others', homeTeam, '2H', CAST(2700 + (matchId * 37) % 240 AS DOUBLE),
           CAST([] AS VARCHAR[])
    FROM f_match_base
    """,
)

_view(
    "f_flagged",
    ("f_events",),
    """
    SELECT *,
           coalesce(event = 'Save attempt' AND list_contains(tags, 'Goal') AND eventTeam = awayTeam, false) AS homeGoal,
           coalesce(event = 'Save attempt' AND list_contains(tags, 'Goal') AND eventTeam = homeTeam, false) AS awayGoal
    FROM f_events
    """,
)

_view(
    "f_match_results",
    ("f_flagged",),
    """
    SELECT matchId, competition, season, homeTeam, awayTeam,
           CAST(count_if(homeGoal) AS BIGINT) AS homeTeamGoals,
           CAST(count_if(awayGoal) AS BIGINT) AS awayTeamGoals
    FROM f_flagged
    GROUP BY matchId, competition, season, homeTeam, awayTeam
    """,
)

_view(
    "f_team_rows",
    ("f_match_results",),
    """
    SELECT matchId, competition, season, homeTeam AS team, awayTeam AS opponent,
           homeTeamGoals AS GF, awayTeamGoals AS GA
    FROM f_match_results
    UNION ALL
    SELECT matchId, competition, season, awayTeam, homeTeam, awayTeamGoals, homeTeamGoals
    FROM f_match_results
    """,
)

_view(
    "f_standings",
    ("f_team_rows",),
    """
    SELECT competition, season, team,
           CAST(count(*) AS BIGINT) AS games,
           CAST(sum(CASE WHEN GF > GA THEN 1 ELSE 0 END) AS BIGINT) AS wins,
           CAST(sum(CASE WHEN GF = GA THEN 1 ELSE 0 END) AS BIGINT) AS draws,
           CAST(sum(CASE WHEN GF < GA THEN 1 ELSE 0 END) AS BIGINT) AS losses,
           CAST(sum(GF) AS BIGINT) AS goalsScored,
           CAST(sum(GA) AS BIGINT) AS goalsConceded,
           CAST(sum(CASE WHEN GF > GA THEN 3 WHEN GF = GA THEN 1 ELSE 0 END) AS BIGINT) AS points
    FROM f_team_rows
    GROUP BY competition, season, team
    """,
)


_view(
    "f_match_passes",
    ("f_events",),
    """
    SELECT matchId, competition, season, eventTeam AS team,
           CAST(count(*) AS BIGINT) AS totalPasses,
           CAST(count_if(list_contains(tags, 'Accurate')) AS BIGINT) AS successfulPasses
    FROM f_events
    WHERE event = 'Pass'
    GROUP BY matchId, competition, season, eventTeam
    """,
)

_view(
    "f_pass_ratio",
    ("f_match_passes",),
    """
    SELECT competition, season, team, avg(successfulPasses / totalPasses * 100) AS ratio
    FROM f_match_passes
    GROUP BY competition, season, team
    """,
)

_view(
    "f_sales",
    (),
    """
    SELECT p.p_brand AS publisher, CAST(l.l_shipdate AS DATE) AS release_date,
           CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18, 2)) END AS na_sales,
           CAST(l.l_extendedprice AS DECIMAL(18, 2)) AS total_sales
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    """,
)

_view(
    "f_sales_window",
    ("f_sales",),
    """
    SELECT * FROM f_sales WHERE release_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    """,
)

_view(
    "f_best_publisher",
    ("f_sales_window",),
    """
    SELECT publisher, CAST(sum(na_sales) AS DECIMAL(38, 2)) AS na_total
    FROM f_sales_window GROUP BY publisher
    ORDER BY na_total DESC NULLS LAST, publisher LIMIT 1
    """,
)

_view(
    "f_length",
    ("f_events",),
    """
    SELECT matchId, CAST(45 + ceil(max(eventTime) / 60) AS BIGINT) AS matchLength
    FROM f_events WHERE eventPeriod = '2H' GROUP BY matchId
    """,
)

_view(
    "f_sides",
    ("f_match_base",),
    """
    SELECT matchId, competition, season, homeTeam AS team, CAST(home_nk AS BIGINT) * 100 AS b, matchId AS k
    FROM f_match_base
    UNION ALL
    SELECT matchId, competition, season, awayTeam, CAST(away_nk AS BIGINT) * 100, matchId + 3
    FROM f_match_base
    """,
)

_view(
    "f_subs",
    ("f_sides",),
    """
    SELECT matchId, competition, season, team, b + 12 AS playerIn, b + 1 + k % 11 AS playerOut,
           CAST(40 + k % 50 AS INTEGER) AS minute
    FROM f_sides
    UNION ALL
    SELECT matchId, competition, season, team, b + 13, b + 1 + (k + 4) % 11, CAST(46 + (k * 7) % 44 AS INTEGER)
    FROM f_sides WHERE k % 3 <> 0
    UNION ALL
    SELECT matchId, competition, season, team, b + 14, b + 12, 90
    FROM f_sides WHERE k % 5 = 0
    """,
)

_view(
    "f_lineup",
    ("f_sides",),
    """
    SELECT matchId, competition, season, team, b + unnest(range(1, 12)) AS playerId, 0 AS startMinute
    FROM f_sides
    """,
)

_view(
    "f_stints",
    ("f_lineup", "f_subs", "f_length"),
    """
    SELECT e.matchId, e.competition, e.season, e.team, e.playerId, e.startMinute, o.minute AS outMinute,
           coalesce(l.matchLength, 90) AS len
    FROM (SELECT matchId, competition, season, team, playerId, startMinute FROM f_lineup
          UNION ALL
          SELECT matchId, competition, season, team, playerIn, minute FROM f_subs) e
    LEFT JOIN f_subs o ON o.matchId = e.matchId AND o.team = e.team AND o.playerOut = e.playerId
    LEFT JOIN f_length l ON l.matchId = e.matchId
    """,
)

_view(
    "f_players",
    (),
    """
    SELECT CAST(n_nationkey AS BIGINT) * 100 + s AS playerId, 'P' || s AS firstName,
           n_name AS lastName, r_name AS birthArea,
           CASE WHEN s IN (1, 12) THEN 'Goalkeeper'
                WHEN s IN (2, 3, 4, 5, 13) THEN 'Defender'
                WHEN s IN (6, 7, 8, 9, 14) THEN 'Midfielder'
                ELSE 'Forward' END AS role,
           'right' AS foot
    FROM (SELECT n.n_nationkey, n.n_name, r.r_name, unnest(range(1, 15)) AS s
          FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
    """,
)

_view(
    "f_goals",
    ("f_flagged",),
    """
    SELECT matchId, competition, season, eventId, eventPeriod, eventTime,
           CASE WHEN homeGoal THEN homeTeam ELSE awayTeam END AS goalTeam,
           CASE WHEN eventPeriod = '2H' THEN 100000.0 ELSE 0.0 END + eventTime AS clock
    FROM f_flagged WHERE homeGoal OR awayGoal
    """,
)


def _sub_clock(m: str) -> str:
    return f"CASE WHEN {m} < 45 THEN {m} * 60.0 ELSE 100000.0 + ({m} - 45) * 60.0 END"


_view(
    "f_pm_events",
    ("f_stints", "f_goals"),
    f"""
    SELECT s.matchId, s.season, s.playerId, s.team, g.eventId, g.eventPeriod, g.eventTime,
           CASE WHEN s.team = g.goalTeam THEN 1 ELSE -1 END AS delta
    FROM f_stints s JOIN f_goals g
      ON s.matchId = g.matchId
     AND g.clock >= {_sub_clock('s.startMinute')}
     AND (s.outMinute IS NULL OR g.clock < {_sub_clock('s.outMinute')})
    """,
)

# Image views. Pixels are exploded to rows here (brute force) and the colour
# of each pixel is found by joining a palette table - a different route from
# the Spark jobs, which keep every image in one row.
_view(
    "f_img",
    (),
    """
    SELECT CAST(doc_id AS VARCHAR) AS filename, 'doc: ' || CAST(doc_id AS VARCHAR) AS annotation,
           source AS "group", 4 AS nChannels,
           unhex(""" + " || ".join(f"md5(concat_ws('-', doc_id, {i}))" for i in range(16)) + """) AS data
    FROM documents
    """,
)

# Pictures of many sizes; every 20th file holds no picture and is read without
# pixels (sizes -1, no bytes).
_view(
    "f_pictures",
    (),
    """
    SELECT a, seed, a % 20 = 19 AS broken,
           CAST(CASE WHEN a % 25 = 1 THEN 1 WHEN a % 100 = 3 THEN 1500 ELSE 1 + (a * 7) % 48 END AS INTEGER) AS h,
           CAST(CASE WHEN a % 25 = 1 THEN 1 WHEN a % 100 = 3 THEN 1100 ELSE 1 + (a * 13) % 64 END AS INTEGER) AS w,
           CASE WHEN a % 3 = 0 THEN 3 ELSE 4 END AS c
    FROM (SELECT doc_id // 16 AS a,
                 md5(CAST(count(doc_id) AS VARCHAR) || '-' || CAST(min(doc_id) AS VARCHAR) || '-' || CAST(max(doc_id) AS VARCHAR)) AS seed
          FROM documents GROUP BY 1)
    """,
)

# Basic colour per rounded (r, g, b), 27 rows.
_view(
    "f_palette",
    (),
    """
    SELECT * FROM (VALUES
        (0, 0, 0, 'Black'), (0, 0, 128, 'Blue'), (0, 0, 255, 'Blue'),
        (0, 128, 0, 'Green'), (0, 128, 128, 'Green'), (0, 128, 255, 'Blue'),
        (0, 255, 0, 'Green'), (0, 255, 128, 'Green'), (0, 255, 255, 'Blue'),
        (128, 0, 0, 'Red'), (128, 0, 128, 'Purple'), (128, 0, 255, 'Purple'),
        (128, 128, 0, 'Green'), (128, 128, 128, 'Gray'), (128, 128, 255, 'Purple'),
        (128, 255, 0, 'Green'), (128, 255, 128, 'Green'), (128, 255, 255, 'Blue'),
        (255, 0, 0, 'Red'), (255, 0, 128, 'Pink'), (255, 0, 255, 'Purple'),
        (255, 128, 0, 'Orange'), (255, 128, 128, 'Orange'), (255, 128, 255, 'Pink'),
        (255, 255, 0, 'Yellow'), (255, 255, 128, 'Yellow'), (255, 255, 255, 'White')
    ) AS t(r, g, b, name)
    """,
)

_view(
    "f_pixels",
    ("f_img",),
    """
    SELECT filename, annotation, "group", i, substr(h, i * 8 + 1, 8) AS px
    FROM (SELECT filename, annotation, "group", h, unnest(range(0, length(h) // 8)) AS i
          FROM (SELECT *, hex(data) AS h FROM f_img))
    """,
)


def _bucket(pos: int) -> str:
    v = f"CAST('0x' || substr(px, {pos}, 2) AS INTEGER)"
    return f"CASE WHEN {v} < 85 THEN 0 WHEN {v} < 170 THEN 128 ELSE 255 END"


_view(
    "f_pixel_colors",
    ("f_pixels", "f_palette"),
    f"""
    SELECT p.filename, p.annotation, p."group", p.i, p.px,
           CASE WHEN CAST('0x' || substr(p.px, 7, 2) AS INTEGER) >= 128 THEN c.name ELSE 'None' END AS color
    FROM f_pixels p JOIN f_palette c
      ON c.r = {_bucket(5)} AND c.g = {_bucket(3)} AND c.b = {_bucket(1)}
    """,
)

_view(
    "f_hist",
    ("f_pixel_colors",),
    """
    SELECT filename, annotation, "group", color, CAST(count(*) AS BIGINT) AS pixels
    FROM f_pixel_colors GROUP BY filename, annotation, "group", color
    """,
)

_view(
    "f_img_totals",
    ("f_hist",),
    """
    SELECT filename, annotation, "group",
           CAST(sum(pixels) AS BIGINT) AS total_pixels,
           CAST(sum(CASE WHEN color <> 'None' THEN pixels ELSE 0 END) AS BIGINT) AS colored_pixels,
           CAST(sum(CASE WHEN color = 'None' THEN pixels ELSE 0 END) AS BIGINT) AS transparent_pixels
    FROM f_hist GROUP BY filename, annotation, "group"
    """,
)

_view(
    "f_top_colors",
    ("f_hist",),
    """
    SELECT *, row_number() OVER (PARTITION BY filename ORDER BY pixels DESC, color) AS rk
    FROM f_hist WHERE color <> 'None'
    """,
)

_view(
    "f_power",
    (),
    """
    SELECT time,
           CAST(CASE WHEN k % 97 <> 0 THEN 15 - 3 * abs(m - 7) + k % 5 END AS DOUBLE) AS temperature,
           CAST(50 + k % 40 AS DOUBLE) AS humidity,
           CAST((7 * k) % 13 AS DOUBLE) AS wind_speed,
           CAST(1000 + 100 * (12 - abs(h - 12)) + k % 50 AS DOUBLE) AS power_tenants,
           CAST(500 + 10 * m AS DOUBLE) AS power_maintenance,
           CAST(100 * greatest(0, 6 - abs(h - 12)) AS DOUBLE) AS power_solar_panels,
           CASE WHEN k % 89 <> 0 THEN o_totalprice / 1000 END AS electricity_price
    FROM (SELECT o_orderkey AS k, o_totalprice,
                 CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 86400
                     + (o_orderkey * 3607) % 86400 AS time,
                 month(o_orderdate) AS m,
                 ((o_orderkey * 3607) % 86400) // 3600 AS h
          FROM orders)
    """,
)

_view(
    "f_calendar",
    ("f_power",),
    """
    SELECT *, CAST(month(epoch_ms(time * 1000)) AS INTEGER) AS month,
           CAST(hour(epoch_ms(time * 1000)) AS INTEGER) AS hour,
           CAST(dayofweek(epoch_ms(time * 1000)) + 1 AS INTEGER) AS dayofweek
    FROM f_power
    """,
)

_view(
    "f_pred",
    (),
    """
    SELECT time, hour, CAST(((hour + k % 5 - 2) % 24 + 24) % 24 AS DOUBLE) AS prediction
    FROM (SELECT o_orderkey AS k,
                 CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 86400
                     + (o_orderkey * 3607) % 86400 AS time,
                 CAST(((o_orderkey * 3607) % 86400) // 3600 AS INTEGER) AS hour
          FROM orders)
    """,
)


def _signed(expr: str) -> str:
    return f"CASE WHEN {expr} > 0 THEN '+' || CAST({expr} AS VARCHAR) ELSE CAST({expr} AS VARCHAR) END"


# ---------------------------------------------------------------- queries

COMPETITION = "EUROPE"
SEASON = "1997"
PASS_TOTAL_ABOVE = 4
PASS_SUCCESSFUL_ABOVE = 2
BEST_TEAMS_PER_LEAGUE = 2


def football_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_parquet"] = with_views(
        """
        SELECT competition, season, matchId, eventId, homeTeam, awayTeam,
               event, eventTeam, eventPeriod, eventTime, tags
        FROM f_events
        """,
        "f_events",
    )
    q["goal_flags"] = with_views(
        "SELECT matchId, eventId, eventPeriod, eventTime, homeGoal, awayGoal FROM f_flagged",
        "f_flagged",
    )
    q["match_results"] = with_views("SELECT * FROM f_match_results", "f_match_results")
    q["match_summary"] = with_views(
        """
        SELECT CAST(count(*) AS BIGINT) AS matches,
               CAST(count_if(homeTeamGoals + awayTeamGoals = 0) AS BIGINT) AS goalless,
               CAST(max(homeTeamGoals + awayTeamGoals) AS BIGINT) AS most_goals,
               CAST(coalesce(sum(homeTeamGoals + awayTeamGoals), 0) AS BIGINT) AS total_goals
        FROM f_match_results
        """,
        "f_match_results",
    )
    q["team_match_rows"] = with_views(
        """
        SELECT matchId, competition, season, team, opponent, GF, GA,
               CAST(GF > GA AS INTEGER) AS W, CAST(GF = GA AS INTEGER) AS D, CAST(GF < GA AS INTEGER) AS L,
               CASE WHEN GF > GA THEN 3 WHEN GF = GA THEN 1 ELSE 0 END AS points
        FROM f_team_rows
        """,
        "f_team_rows",
    )
    q["season_standings"] = with_views("SELECT * FROM f_standings", "f_standings")
    q["season_standings_outer"] = q["season_standings"]
    q["league_table"] = with_views(
        f"""
        SELECT CAST(row_number() OVER (PARTITION BY competition, season
                    ORDER BY points DESC, goalsScored - goalsConceded DESC, goalsScored DESC, team) AS INTEGER) AS Pos,
               team AS Team, games AS Pld, wins AS W, draws AS D, losses AS L,
               goalsScored AS GF, goalsConceded AS GA,
               {_signed('goalsScored - goalsConceded')} AS GD, points AS Pts
        FROM f_standings
        WHERE competition = '{COMPETITION}' AND season = '{SEASON}'
        """,
        "f_standings",
    )
    q["match_passes"] = with_views("SELECT * FROM f_match_passes", "f_match_passes")
    q["pass_thresholds"] = with_views(
        f"""
        SELECT CAST(count(*) AS BIGINT) AS rows,
               CAST(count_if(totalPasses > {PASS_TOTAL_ABOVE}) AS BIGINT) AS high_total,
               CAST(count_if(successfulPasses > {PASS_SUCCESSFUL_ABOVE}) AS BIGINT) AS high_successful
        FROM f_match_passes
        """,
        "f_match_passes",
    )
    q["season_pass_ratio"] = with_views(
        f"""
        SELECT competition, season, team, round(ratio, 2) AS passSuccessRatio
        FROM f_pass_ratio WHERE season = '{SEASON}'
        """,
        "f_pass_ratio",
    )
    q["worst_passers"] = with_views(
        f"""
        SELECT competition, team, round(ratio, 2) AS passSuccessRatio
        FROM (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY ratio, team) AS rn
              FROM f_pass_ratio WHERE season = '{SEASON}')
        WHERE rn = 1
        """,
        "f_pass_ratio",
    )
    stats = f"""
        SELECT competition, season, team, Pld, W, D, L, GF, GA, 3 * W + D AS Pts, GF - GA AS GD,
               round((3 * W + D) / Pld, 2) AS Avg
        FROM (SELECT competition, season, team, CAST(count(*) AS BIGINT) AS Pld,
                     CAST(sum(CASE WHEN GF > GA THEN 1 ELSE 0 END) AS BIGINT) AS W,
                     CAST(sum(CASE WHEN GF = GA THEN 1 ELSE 0 END) AS BIGINT) AS D,
                     CAST(sum(CASE WHEN GF < GA THEN 1 ELSE 0 END) AS BIGINT) AS L,
                     CAST(sum(GF) AS BIGINT) AS GF, CAST(sum(GA) AS BIGINT) AS GA
              FROM f_team_rows WHERE season = '{SEASON}'
              GROUP BY competition, season, team)
    """
    q["team_season_stats"] = with_views(stats, "f_team_rows")
    with_pass = f"""
        SELECT s.*, round(p.ratio, 2) AS PassRatio, p.ratio AS raw_ratio
        FROM ({stats}) s LEFT JOIN f_pass_ratio p
          ON s.competition = p.competition AND s.season = p.season AND s.team = p.team
    """
    q["team_stats_with_passes"] = with_views(
        f"SELECT * EXCLUDE (raw_ratio) FROM ({with_pass})", "f_team_rows", "f_pass_ratio"
    )
    q["best_teams"] = with_views(
        f"""
        SELECT team AS Team, competition AS League, CAST(Pos AS INTEGER) AS Pos, Pld, W, D, L, GF, GA,
               {_signed('GD')} AS GD, Pts, Avg, PassRatio
        FROM (SELECT *, row_number() OVER (PARTITION BY competition, season
                                           ORDER BY Pts / Pld DESC, Pos) AS pick
              FROM (SELECT *, row_number() OVER (PARTITION BY competition, season
                                                 ORDER BY Pts DESC, GD DESC, GF DESC, team) AS Pos
                    FROM ({with_pass})))
        WHERE pick <= {BEST_TEAMS_PER_LEAGUE}
        """,
        "f_team_rows",
        "f_pass_ratio",
    )
    return q


def sales_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_csv_layouts"] = with_views("SELECT * FROM f_sales", "f_sales")
    q["scan_csv"] = with_views("SELECT * FROM f_sales", "f_sales")
    q["sales_window"] = with_views("SELECT * FROM f_sales_window", "f_sales_window")
    q["sales_top_publisher"] = with_views("SELECT * FROM f_best_publisher", "f_best_publisher")
    q["sales_missing_count"] = with_views(
        """
        SELECT w.publisher, CAST(count_if(w.na_sales IS NULL) AS BIGINT) AS missing
        FROM f_sales_window w JOIN f_best_publisher b ON w.publisher IS NOT DISTINCT FROM b.publisher
        GROUP BY w.publisher
        """,
        "f_best_publisher",
    )
    q["sales_yearly_totals"] = with_views(
        """
        SELECT CAST(year(w.release_date) AS INTEGER) AS year,
               CAST(sum(w.na_sales) AS DECIMAL(38, 2)) AS na_total,
               CAST(sum(w.total_sales) AS DECIMAL(38, 2)) AS global_total
        FROM f_sales_window w JOIN f_best_publisher b ON w.publisher IS NOT DISTINCT FROM b.publisher
        GROUP BY year(w.release_date)
        """,
        "f_best_publisher",
    )
    return q


PLUS_MINUS_ABOVE = 40


def players_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["match_length"] = with_views("SELECT * FROM f_length", "f_length")
    q["lineup_rows"] = with_views("SELECT * FROM f_lineup", "f_lineup")
    q["substitution_rows"] = with_views("SELECT * FROM f_subs", "f_subs")
    stint_cols = """
        matchId, competition, season, team, playerId, startMinute,
        least(coalesce(outMinute, len), len) AS endMinute,
        least(coalesce(outMinute, len), len) - least(startMinute, len) AS minutes
    """
    q["player_stints"] = with_views(f"SELECT {stint_cols} FROM f_stints", "f_stints")
    minutes = f"""
        SELECT season, playerId, CAST(sum(minutes) AS BIGINT) AS minutes
        FROM (SELECT {stint_cols} FROM f_stints) GROUP BY season, playerId
    """
    q["player_minutes"] = with_views(minutes, "f_stints")
    q["top_minutes_by_role"] = with_views(
        f"""
        SELECT role, player, birthArea, minutes FROM (
            SELECT p.role, p.firstName || ' ' || p.lastName AS player, p.birthArea, m.minutes,
                   row_number() OVER (PARTITION BY p.role ORDER BY m.minutes DESC, m.playerId) AS rn
            FROM ({minutes}) m JOIN f_players p ON p.playerId = m.playerId
            WHERE m.season = '{SEASON}')
        WHERE rn = 1
        """,
        "f_stints",
        "f_players",
    )
    q["goal_team"] = with_views(
        "SELECT matchId, competition, season, eventId, eventPeriod, eventTime, goalTeam FROM f_goals",
        "f_goals",
    )
    q["plus_minus_events"] = with_views("SELECT * FROM f_pm_events", "f_pm_events")
    q["plus_minus_above"] = with_views(
        f"""
        SELECT p.firstName || ' ' || p.lastName AS player, p.birthArea, p.role, pm.plusMinus
        FROM (SELECT playerId, CAST(sum(delta) AS BIGINT) AS plusMinus
              FROM f_pm_events GROUP BY playerId) pm
        JOIN f_players p ON p.playerId = pm.playerId
        WHERE pm.plusMinus > {PLUS_MINUS_ABOVE}
        """,
        "f_pm_events",
        "f_players",
    )
    return q


COLOR_SIGNATURE = ("Green", "Blue", "Purple")
RED_GROUP = "src1"


def colors_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_images"] = with_views(
        """
        SELECT 'album ' || CAST(a AS VARCHAR) AS filename,
               CASE WHEN broken THEN -1 ELSE h END AS height,
               CASE WHEN broken THEN -1 ELSE w END AS width,
               CASE WHEN broken THEN -1 ELSE c END AS nChannels,
               CASE WHEN broken THEN -1 WHEN c = 3 THEN 16 ELSE 24 END AS mode,
               CAST(CASE WHEN broken THEN 0 ELSE h * w * c END AS BIGINT) AS n_bytes,
               md5(CASE WHEN broken THEN '' ELSE substr(repeat(upper(seed), CAST(ceil(h * w * c / 16) AS BIGINT)), 1, 2 * h * w * c) END) AS data_md5
        FROM f_pictures
        """,
        "f_pictures",
    )
    q["scan_jsonl_malformed"] = """
        SELECT CASE WHEN doc_id % 50 = 7 OR doc_id % 70 = 9 THEN 'malformed' ELSE 'parsed' END AS channel,
               CASE WHEN doc_id % 50 = 7 THEN '{"hexcode":"' || CAST(doc_id AS VARCHAR) || '","annotation":"doc'
                    WHEN doc_id % 70 = 9 THEN '{"hexcode":"' || CAST(doc_id AS VARCHAR) || '","annotation":"doc: ' || CAST(doc_id AS VARCHAR) || '","group":[7}'
                    ELSE CAST(doc_id AS VARCHAR) END AS content
        FROM documents"""
    level = lambda at: _bucket(at).replace("CAST('0x'", "TRY_CAST('0x'")
    q["picture_histogram"] = with_views(
        f"""
        , pixels AS (
          SELECT filename, substr(seed || seed, CAST(2 * ((c * i) % 16) + 1 AS BIGINT), 2 * c) AS px
          FROM (SELECT 'album ' || CAST(a AS VARCHAR) AS filename, upper(seed) AS seed, c, unnest(range(0, h * w)) AS i FROM f_pictures WHERE NOT broken)
          UNION ALL
          SELECT filename, substr(hx, CAST(2 * c * i + 1 AS BIGINT), 2 * c) AS px
          FROM (SELECT *, unnest(range(0, CAST(ceil(length(hx) / (2 * c)) AS BIGINT))) AS i
                FROM (SELECT 'album ' || CAST(a AS VARCHAR) AS filename, c, hex(encode('no picture ' || seed)) AS hx FROM f_pictures WHERE broken))),
        counted AS (SELECT filename, px, count(*) AS k FROM pixels GROUP BY filename, px)
        SELECT filename, CASE WHEN length(px) = 8 AND TRY_CAST('0x' || substr(px, 7, 2) AS INTEGER) >= 128 THEN p.name ELSE 'None' END AS color,
               CAST(sum(k) AS BIGINT) AS pixels
        FROM counted LEFT JOIN f_palette p
          ON length(px) = 8 AND p.r = {level(5)} AND p.g = {level(3)} AND p.b = {level(1)}
        GROUP BY ALL
        """,
        "f_pictures",
        "f_palette",
    )
    q["scan_jsonl"] = with_views('SELECT filename AS hexcode, annotation, "group" FROM f_img', "f_img")
    q["image_metadata_join"] = with_views(
        'SELECT filename, annotation, "group", nChannels, hex(data) AS data_hex FROM f_img', "f_img"
    )
    q["pixel_hex"] = with_views(
        "SELECT filename, list(px ORDER BY i) AS pixels FROM f_pixels GROUP BY filename", "f_pixels"
    )
    q["pixel_color"] = with_views(
        "SELECT filename, list(color ORDER BY i) AS colors FROM f_pixel_colors GROUP BY filename",
        "f_pixel_colors",
    )
    q["color_histogram"] = with_views("SELECT * FROM f_hist", "f_hist")
    q["most_colored"] = with_views(
        """
        SELECT annotation, colored_pixels FROM f_img_totals
        ORDER BY colored_pixels DESC, annotation, filename LIMIT 4
        """,
        "f_img_totals",
    )
    q["least_colored_ratio"] = with_views(
        """
        SELECT annotation, colored_pixels, transparent_pixels,
               round(colored_pixels / NULLIF(transparent_pixels, 0), 4) AS colored_ratio
        FROM f_img_totals
        ORDER BY coalesce(colored_pixels / NULLIF(total_pixels, 0), 0.0), annotation, filename LIMIT 5
        """,
        "f_img_totals",
    )
    q["top_colors_share"] = with_views(
        """
        SELECT t.annotation, CAST(t.rk AS INTEGER) AS rank, t.color, t.pixels,
               round(t.pixels / s.colored_pixels * 100, 2) AS share
        FROM f_top_colors t JOIN f_img_totals s ON s.filename = t.filename
        WHERE t.rk <= 3
        """,
        "f_top_colors",
        "f_img_totals",
    )
    wanted = ", ".join(f"'{c}'" for c in COLOR_SIGNATURE)
    q["color_signature_count"] = with_views(
        f"""
        SELECT '{"-".join(COLOR_SIGNATURE)}' AS signature, CAST(count(*) AS BIGINT) AS images
        FROM (SELECT filename, list(color ORDER BY rk) AS top3
              FROM f_top_colors WHERE rk <= {len(COLOR_SIGNATURE)} GROUP BY filename)
        WHERE top3 = [{wanted}]
        """,
        "f_top_colors",
    )
    q["most_red_in_group"] = with_views(
        f"""
        SELECT annotation, pixels AS red_pixels FROM f_hist
        WHERE "group" = '{RED_GROUP}' AND color = 'Red'
        ORDER BY pixels DESC, annotation, filename LIMIT 5
        """,
        "f_hist",
    )
    return q


SCALED = ("power_tenants", "power_maintenance", "electricity_price")


def classify_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["calendar_features"] = with_views("SELECT time, month, hour, dayofweek FROM f_calendar", "f_calendar")
    seven = ["temperature", "humidity", "wind_speed", "power_tenants", "power_maintenance",
             "power_solar_panels", "electricity_price"]
    complete = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in seven)
    q["drop_incomplete"] = with_views(f"SELECT * FROM f_calendar WHERE {complete} AND month IS NOT NULL", "f_calendar")
    q["ml_assemble"] = with_views(
        """
        SELECT time, [temperature, humidity, wind_speed] AS features FROM f_power
        WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND wind_speed IS NOT NULL
        """,
        "f_power",
    )
    # MinMaxScaler to [0, 1]: (x - min) * (1 / (max - min)) + 0, or 0.5 for a
    # constant column; min / max over the complete rows.
    clean = " AND ".join(f"{c} IS NOT NULL" for c in SCALED)
    scaled = ", ".join(
        f"CASE WHEN mx{i} <> mn{i} THEN ({c} - mn{i}) * (1.0 / (mx{i} - mn{i})) + 0.0 ELSE 0.5 END"
        for i, c in enumerate(SCALED)
    )
    bounds = ", ".join(f"min({c}) OVER () AS mn{i}, max({c}) OVER () AS mx{i}" for i, c in enumerate(SCALED))
    q["minmax_scale"] = with_views(
        f"""
        SELECT time, [{scaled}] AS scaled
        FROM (SELECT *, {bounds} FROM f_power WHERE {clean})
        """,
        "f_power",
    )
    q["train_test_split"] = with_views(
        "SELECT time, CAST('0x' || substr(md5(CAST(time AS VARCHAR) || ':1'), 1, 8) AS BIGINT) % 1000000 < 800000 AS train FROM f_power",
        "f_power",
    )
    q["eval_accuracy"] = with_views(
        "SELECT count_if(prediction = hour) / count(*) AS accuracy FROM f_pred", "f_pred"
    )
    q["eval_cyclic"] = with_views(
        """
        SELECT round(count_if(d = 0) / count(*) * 100, 2) AS correct,
               round(count_if(d <= 1) / count(*) * 100, 2) AS within_one,
               round(count_if(d <= 2) / count(*) * 100, 2) AS within_two
        FROM (SELECT least(abs(CAST(prediction AS INTEGER) - hour), 24 - abs(CAST(prediction AS INTEGER) - hour)) AS d
              FROM f_pred)
        """,
        "f_pred",
    )
    q["eval_true_probability"] = with_views(
        "SELECT round(avg(CASE WHEN prediction = hour THEN 0.6 ELSE 0.4 / 23 END), 4) AS avg_prob FROM f_pred",
        "f_pred",
    )
    return q


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(classify_sql())
    out.update(model_sql(with_views))
    out.update(colors_sql())
    out.update(players_sql())
    out.update(football_sql())
    out.update(sales_sql())
    return out
