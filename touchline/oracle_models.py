"""DuckDB SQL that fits and applies the classifiers.

Forest and naive Bayes are written again from their definitions: the forest's
rows are joined level by level with the node they are in and left and right label
weights come from plain joins of bins below a cut (the Spark job uses running
sums of squares); naive Bayes is its closed form.
"""

from __future__ import annotations

import math

WEATHER = ["temperature", "humidity", "wind_speed"]
POWER = ["power_tenants", "power_maintenance", "power_solar_panels"]
SEVEN = [*WEATHER, *POWER, "electricity_price"]
EXTRA = ["power_tenants", "power_maintenance", "electricity_price"]
FIRST = {"month": 1, "hour": 0, "dayofweek": 1}
PERIOD = {"month": 12, "hour": 24, "dayofweek": 7}
TREES, DEPTH, BINS, SAMPLE, UNIT = 20, 5, 32, 100_000, 1_000_000_000


def _draws(digest: str) -> str:
    """Poisson draw with mean 1: cumulative probabilities passed by the digest."""
    passed = []
    total = 0.0
    for k in range(7):
        total += math.exp(-1) / math.factorial(k)
        passed.append(f"CAST({digest} >= '{int(total * 4294967296):08x}' AS INTEGER)")
    return " + ".join(passed)


def _data(p: str, inputs: list[str], label: str) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in inputs)
    return f"""
    {p}data AS MATERIALIZED (
      SELECT row_number() OVER () AS id, time, {", ".join(inputs)}, {label}, {label} - {FIRST[label]} AS y,
             CAST('0x' || substr(md5(CAST(time AS VARCHAR) || ':1'), 1, 8) AS BIGINT) % 1000000 < 800000 AS train
      FROM f_calendar WHERE {complete} AND {label} IS NOT NULL)"""


def forest_ctes(p: str, inputs: list[str], label: str) -> list[str]:
    """CTEs whose names begin with ``p``; the last is ``{p}votes`` (id, y, v)."""
    columns = " UNION ALL ".join(f"SELECT id, time, train, {i} AS f, {c} AS x FROM {p}data" for i, c in enumerate(inputs))
    tries = math.ceil(math.sqrt(len(inputs)))
    ctes = [
        _data(p, inputs, label),
        f"{p}feats AS MATERIALIZED ({columns})",
        f"{p}size AS MATERIALIZED (SELECT count(*) AS n FROM {p}data WHERE train)",
        f"""{p}counts AS MATERIALIZED (
      SELECT f, x, count(*) AS k FROM {p}feats, {p}size
      WHERE train AND (n <= {SAMPLE} OR substr(md5(CAST(time AS VARCHAR) || ':bins'), 1, 8) < printf('%08x', ({SAMPLE} * 4294967296) // n))
      GROUP BY f, x)""",
        f"""{p}cuts AS MATERIALIZED (
      SELECT f, x FROM (SELECT f, x, k, sum(k) OVER (PARTITION BY f ORDER BY x) AS c, sum(k) OVER (PARTITION BY f) AS n FROM {p}counts)
      WHERE c < n AND (c * {BINS}) // n > ((c - k) * {BINS}) // n)""",
        f"""{p}binned AS MATERIALIZED (
      SELECT e.id, e.f, count(c.x) AS b FROM {p}feats e LEFT JOIN {p}cuts c ON c.f = e.f AND c.x < e.x GROUP BY e.id, e.f)""",
        f"""{p}n0 AS MATERIALIZED (
      SELECT id, y, tree, w, 1 AS node FROM (
        SELECT id, y, tree, {_draws("digest")} AS w FROM (
          SELECT id, y, tree, substr(md5(CAST(time AS VARCHAR) || ':1:' || CAST(tree // 4 AS VARCHAR)), CAST(1 + 8 * (tree % 4) AS BIGINT), 8) AS digest
          FROM {p}data, (SELECT unnest(range({TREES})) AS tree) WHERE train)) WHERE w > 0)""",
        f"""{p}chosen AS MATERIALIZED (
      SELECT tree, node, f FROM (
        SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node ORDER BY md5('1:' || tree || ':' || node || ':' || f), f) AS rank
        FROM (SELECT unnest(range({TREES})) AS tree), (SELECT unnest(range(1, {1 << DEPTH})) AS node), (SELECT unnest(range({len(inputs)})) AS f))
      WHERE rank <= {tries})""",
        f"{p}t0 AS MATERIALIZED (SELECT id, tree, 1 AS node FROM {p}data, (SELECT unnest(range({TREES})) AS tree) WHERE NOT train)",
    ]
    for k in range(DEPTH):
        moved = f"CASE WHEN s.f IS NULL THEN n.node ELSE 2 * n.node + CAST(b.b > s.b AS INTEGER) END AS node"
        follow = f"LEFT JOIN {p}best{k} s ON s.tree = n.tree AND s.node = n.node LEFT JOIN {p}binned b ON b.id = n.id AND b.f = s.f"
        ctes += [
            f"""{p}h{k} AS MATERIALIZED (
      SELECT n.tree, n.node, c.f, b.b, n.y, sum(n.w) AS w
      FROM {p}n{k} n JOIN {p}chosen c ON c.tree = n.tree AND c.node = n.node JOIN {p}binned b ON b.id = n.id AND b.f = c.f
      WHERE n.node >= {1 << k} GROUP BY ALL)""",
            f"""{p}left{k} AS MATERIALIZED (
      SELECT g.tree, g.node, g.f, g.b, h.y, sum(h.w) AS w
      FROM (SELECT DISTINCT tree, node, f, b FROM {p}h{k}) g JOIN {p}h{k} h ON h.tree = g.tree AND h.node = g.node AND h.f = g.f AND h.b <= g.b
      GROUP BY ALL)""",
            f"""{p}all{k} AS MATERIALIZED (SELECT tree, node, f, y, sum(w) AS w FROM {p}h{k} GROUP BY ALL)""",
            f"""{p}best{k} AS MATERIALIZED (
      SELECT tree, node, f, b FROM (
        SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY sl / l + sr / (n - l) DESC, f, b) AS rank FROM (
          SELECT g.tree, g.node, g.f, g.b, CAST(sum(coalesce(e.w, 0)) AS DOUBLE) AS l, CAST(sum(a.w) AS DOUBLE) AS n,
                 CAST(sum(coalesce(e.w, 0) * coalesce(e.w, 0)) AS DOUBLE) AS sl,
                 CAST(sum((a.w - coalesce(e.w, 0)) * (a.w - coalesce(e.w, 0))) AS DOUBLE) AS sr, CAST(sum(a.w * a.w) AS DOUBLE) AS s
          FROM (SELECT DISTINCT tree, node, f, b FROM {p}h{k}) g JOIN {p}all{k} a ON a.tree = g.tree AND a.node = g.node AND a.f = g.f
          LEFT JOIN {p}left{k} e ON e.tree = g.tree AND e.node = g.node AND e.f = g.f AND e.b = g.b AND e.y = a.y
          GROUP BY ALL)
        WHERE l < n AND sl / l + sr / (n - l) > s / n) WHERE rank = 1)""",
            f"{p}n{k + 1} AS MATERIALIZED (SELECT n.id, n.y, n.tree, n.w, {moved} FROM {p}n{k} n {follow})",
            f"{p}t{k + 1} AS MATERIALIZED (SELECT n.id, n.tree, {moved} FROM {p}t{k} n {follow})",
        ]
    ctes += [
        f"{p}leaf AS MATERIALIZED (SELECT tree, node, y, sum(w) AS w, sum(sum(w)) OVER (PARTITION BY tree, node) AS n FROM {p}n{DEPTH} GROUP BY tree, node, y)",
        f"""{p}votes AS MATERIALIZED (
      SELECT t.id, f.y, CAST(sum(({UNIT} * f.w) // f.n) AS BIGINT) AS v FROM {p}t{DEPTH} t JOIN {p}leaf f ON f.tree = t.tree AND f.node = t.node GROUP BY t.id, f.y)""",
        f"""{p}pred AS MATERIALIZED (
      SELECT d.time, CAST(d.{label} AS DOUBLE) AS {label}, CAST(c.y + {FIRST[label]} AS DOUBLE) AS prediction,
             coalesce(v.v, 0) / {float(UNIT * TREES)} AS p
      FROM {p}data d
      JOIN (SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY v DESC, y) AS rank FROM {p}votes) c ON c.id = d.id AND c.rank = 1
      LEFT JOIN {p}votes v ON v.id = d.id AND v.y = d.y)""",
    ]
    return ctes


def bayes_ctes(p: str, inputs: list[str], label: str) -> list[str]:
    """Multinomial naive Bayes (smoothing 1) on min-max scaled inputs; values
    below the training minimum are raised to it."""
    k = len(inputs)
    bounds = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(inputs))
    scaled = ", ".join(f"CASE WHEN hi{i} <> lo{i} THEN (greatest({c}, lo{i}) - lo{i}) * (1.0 / (hi{i} - lo{i})) ELSE 0.5 END AS x{i}" for i, c in enumerate(inputs))
    sums = ", ".join(f"sum(x{i}) AS s{i}" for i in range(k))
    total = " + ".join(f"s{i}" for i in range(k))
    log_odds = " + ".join(f"x{i} * (ln(s{i} + 1) - ln({total} + {k}))" for i in range(k))
    return [
        _data(p, inputs, label),
        f"{p}bounds AS MATERIALIZED (SELECT {bounds} FROM {p}data WHERE train)",
        f"{p}x AS MATERIALIZED (SELECT id, time, {label}, y, train, {scaled} FROM {p}data, {p}bounds)",
        f"{p}class AS MATERIALIZED (SELECT y AS c, count(*) AS n, {sums} FROM {p}x WHERE train GROUP BY y)",
        f"""{p}score AS MATERIALIZED (
      SELECT id, c, ln(n + 1) - ln((SELECT sum(n) + count(*) FROM {p}class)) + {log_odds} AS score FROM {p}x, {p}class WHERE NOT train)""",
        f"""{p}pred AS MATERIALIZED (
      SELECT x.time, CAST(x.{label} AS DOUBLE) AS {label}, CAST(b.c + {FIRST[label]} AS DOUBLE) AS prediction, coalesce(t.p, 0) AS p
      FROM {p}x x
      JOIN (SELECT id, c, row_number() OVER (PARTITION BY id ORDER BY score DESC, c) AS rank FROM {p}score) b ON b.id = x.id AND b.rank = 1
      LEFT JOIN (SELECT id, c, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY id) AS p
                 FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM {p}score)) t ON t.id = x.id AND t.c = x.y)""",
    ]


def _report(p: str, classifier: str, inputs: list[str], label: str) -> str:
    d = f"least(abs(CAST(prediction AS INTEGER) - CAST({label} AS INTEGER)), {PERIOD[label]} - abs(CAST(prediction AS INTEGER) - CAST({label} AS INTEGER)))"
    return f"""SELECT '{classifier}' AS classifier, '{",".join(inputs)}' AS input, '{label}' AS label,
      round(count_if({d} = 0) / count(*) * 100, 2) AS correct, round(count_if({d} <= 1) / count(*) * 100, 2) AS within_one,
      round(count_if({d} <= 2) / count(*) * 100, 2) AS within_two, round(avg(p), 4) AS avg_prob FROM {p}pred"""


def model_sql(with_views) -> dict[str, str]:
    def query(ctes: list[str], body: str) -> str:
        return with_views("," + ",\n".join(ctes) + "\n" + body, "f_calendar")

    cases = [(label, inputs) for label in ("month", "hour") for inputs in (WEATHER, POWER, SEVEN)] + [("dayofweek", EXTRA)]
    ctes, rows = [], []
    for i, (label, inputs) in enumerate(cases):
        ctes += forest_ctes(f"r{i}_", inputs, label)
        rows.append(_report(f"r{i}_", "RandomForest", inputs, label))
    ctes += bayes_ctes("nb_", EXTRA, "dayofweek")
    rows.append(_report("nb_", "NaiveBayes", EXTRA, "dayofweek"))
    return {
        "rf_predict": query(forest_ctes("r_", WEATHER, "month"), "SELECT time, month, prediction FROM r_pred"),
        "nb_predict": query(bayes_ctes("nb_", EXTRA, "dayofweek"), "SELECT time, dayofweek, prediction FROM nb_pred"),
        "classifier_report": query(ctes, " UNION ALL ".join(rows)),
    }
