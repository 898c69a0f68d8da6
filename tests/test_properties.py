"""Column expressions against brute force on many seeded random cases (one job each)."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from touchline.functions.football import signed
from touchline.functions.pixels import BASIC_COLORS, pixel_color
from touchline.operators.classify import cyclic_distance


def _level(v: int) -> int:
    return 0 if v < 85 else 128 if v < 170 else 255


def _expected_color(blue: int, green: int, red: int, alpha: int) -> str:
    if alpha < 128:
        return "None"
    return BASIC_COLORS[(_level(red), _level(green), _level(blue))]


def test_pixel_color_matches_brute_force(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(2000):
        b, g, r, a = (rng.choice([0, 84, 85, 127, 128, 169, 170, 255, rng.randrange(256)]) for _ in range(4))
        text = f"{b:02X}{g:02X}{r:02X}{a:02X}"
        if rng.random() < 0.3:
            text = text.lower()
        cases.append((text, _expected_color(b, g, r, a)))
    df = spark.createDataFrame(cases, "h string, expected string")
    bad = df.filter(pixel_color(F.col("h")) != F.col("expected")).collect()
    assert bad == []


def test_cyclic_distance_matches_brute_force(spark):
    rng = random.Random(11)
    cases = []
    for _ in range(1000):
        period = rng.choice([7, 12, 24])
        lo = 1 if period != 24 else 0
        p, y = rng.randrange(lo, lo + period), rng.randrange(lo, lo + period)
        d = abs(p - y)
        cases.append((p, y, period, min(d, period - d)))
    df = spark.createDataFrame(cases, "p int, y int, period int, expected int")
    bad = [
        r
        for period in (7, 12, 24)
        for r in df.filter(F.col("period") == period)
        .filter(cyclic_distance(F.col("p"), F.col("y"), period) != F.col("expected"))
        .collect()
    ]
    assert bad == []


def test_signed_matches_brute_force(spark):
    values = list(range(-30, 31)) + [10**9, -(10**9)]
    df = spark.createDataFrame([(v, f"+{v}" if v > 0 else str(v)) for v in values], "v long, expected string")
    assert df.filter(signed(F.col("v")) != F.col("expected")).count() == 0
