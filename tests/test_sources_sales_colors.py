"""File sources (CSV, JSON lines, PNG images), sales jobs and colour questions."""

from __future__ import annotations

import datetime as dt
import json
import os
import struct
import zlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.pixels import pixel_color, pixel_hex
from touchline.operators import colors as C
from touchline.operators import sales as S
from touchline.sources import read_images, read_metadata, read_sales_csv


# ---------------------------------------------------------------- sales


def _write_sales(path):
    lines = [
        "title|publisher|release_date|na_sales|total_sales",
        "a|P1|2006-05-01|1.50|2.00",
        "b|P1|2007-01-01||1.00",
        "c|P1|2005-12-31|9.00|9.00",  # outside the window
        "d|P2|2010-03-03|1.00|1.25",
        "e|P2||5.00|5.00",  # no release date: drops out of the window
        "f|P3|2012-02-02||3.00",  # all-null NA total sorts last
    ]
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _sales(spark, tmp_dir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("title", T.StringType())] + list(schemas.SALES.fields))
    path = os.path.join(tmp_dir, "sales")
    _write_sales(path)
    return S.released_between(read_sales_csv(spark, path, schema), "2006-01-01", "2015-12-31")


def test_csv_reader_uses_the_schema(spark, tmp_dir):
    df = _sales(spark, tmp_dir)
    assert dict(df.dtypes)["release_date"] == "date"
    assert dict(df.dtypes)["na_sales"] == "decimal(18,2)"
    assert sorted(r.title for r in df.collect()) == ["a", "b", "d", "f"]


def test_best_publisher_missing_and_yearly(spark, tmp_dir):
    df = _sales(spark, tmp_dir)
    best = S.best_publisher(df).collect()
    assert [(r.publisher, r.na_total) for r in best] == [("P1", Decimal("1.50"))]
    missing = S.missing_measure_count(df, "publisher", "release_date", "na_sales").collect()
    assert [(r.publisher, r.missing) for r in missing] == [("P1", 1)]
    yearly = S.publisher_yearly_totals(df).collect()
    assert [(r.year, r.na_total, r.global_total) for r in yearly] == [
        (2006, Decimal("1.50"), Decimal("2.00")),
        (2007, None, Decimal("1.00")),
    ]


def test_best_publisher_of_empty_input_is_empty(spark, tmp_dir):
    df = _sales(spark, tmp_dir).filter(F.lit(False))
    assert S.best_publisher(df).count() == 0
    assert S.publisher_yearly_totals(df).count() == 0


def test_null_group_is_a_group(spark):
    rows = [(None, "2001-01-01", 9.0), ("a", "2001-02-01", 5.0), ("b", "2002-01-01", 1.0)]
    df = spark.createDataFrame(rows, "g string, d string, v double").withColumn("d", F.col("d").cast("date"))
    best = S.missing_measure_count(df, "g", "d", "v").collect()
    assert [(r.g, r.missing) for r in best] == [(None, 0)]
    assert [(r.year, r.v) for r in S.yearly_totals(df, "g", "d", ["v"]).collect()] == [(2001, 9.0)]


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide.csv")
    with open(path, "w") as f:
        f.write("extra|publisher|release_date|total_sales|na_sales\nx|p|2001-01-01|2.00|1.50\n")
    row = read_sales_csv(spark, path).first()
    assert (row.publisher, float(row.na_sales), float(row.total_sales)) == ("p", 1.5, 2.0)
    with open(path, "w") as f:
        f.write("publisher|release_date|total_sales\np|2001-01-01|2.00\n")
    with pytest.raises(ValueError, match="na_sales"):
        read_sales_csv(spark, path)


def test_undecodable_image_keeps_its_row(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "bad one.PNG"), "wb") as f:
        f.write(b"no picture")
    found = C.color_counts(C.image_files(read_images(spark, tmp_dir))).collect()
    assert [(r.filename, r.total_pixels) for r in found] == [("bad one", 0)]


# ---------------------------------------------------------------- images


def _png(path, width, height, rgba_rows):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + bytes(row) for row in rgba_rows)
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    with open(path, "wb") as fh:
        fh.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_source_returns_bgra_mode_24(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "img")
    os.makedirs(folder)
    # pixel 1: opaque red; pixel 2: fully transparent blue
    _png(os.path.join(folder, "1F600.png"), 2, 1, [[255, 0, 0, 255, 0, 0, 255, 0]])
    with open(os.path.join(tmp_dir, "meta.jsonl"), "w") as fh:
        fh.write(json.dumps({"hexcode": "1F600", "annotation": "grinning", "group": "smileys", "extra": 1}) + "\n")
        fh.write(json.dumps({"hexcode": "FFFF", "annotation": "not loaded", "group": "x"}) + "\n")
    images = read_images(spark, os.path.join(folder, "*.png"))
    row = images.select("image.*").first()
    assert (row.width, row.height, row.nChannels, row.mode) == (2, 1, 4, 24)
    assert bytes(row.data) == bytes([0, 0, 255, 255, 255, 0, 0, 0])
    meta = read_metadata(spark, os.path.join(tmp_dir, "meta.jsonl"))
    joined = C.images_with_metadata(images, meta)
    profile = C.color_profile(joined).first()
    assert (profile.annotation, profile.total_pixels, profile.colored_pixels) == ("grinning", 2, 1)
    assert [(e.color, e.pixels) for e in profile.palette] == [("Red", 1)]
    # counts first, then the metadata join: same answer
    counted_first = C.color_profile(images, meta).collect()
    assert [tuple(r) for r in counted_first] == [tuple(profile)]


def test_pixel_expressions(spark):
    df = spark.createDataFrame(
        [(bytes([0, 0, 255, 255, 10, 200, 250, 200, 1, 2, 3, 100]), 4), (b"", 4)], "data binary, ch int"
    )
    hexes = [r.h for r in df.select(pixel_hex(F.col("data"), F.col("ch")).alias("h")).collect()]
    assert hexes == [["0000FFFF", "0AC8FAC8", "01020364"], []]
    names = spark.createDataFrame(
        [("0000FFFF",), ("0AC8FAC8",), ("01020364",), ("zz00FFFF",), ("0000ff",), ("ffffff80",), (None,)], "h string"
    ).select(pixel_color(F.col("h")).alias("c"))
    # red; (250,200,10)->(255,255,0) yellow; alpha 100 transparent; malformed; short; white; null
    assert [r.c for r in names.collect()] == ["Red", "Yellow", "None", "None", "None", "White", "None"]


def test_colour_invariants_on_fixture(spark):
    from data_folders import SF_SMALL
    from touchline.sources import fixtures as fx

    profile = C.color_profile(C.images_with_metadata(fx.images(spark, SF_SMALL), fx.image_meta(spark, SF_SMALL)))
    hist = C.color_histogram(profile)
    sums = hist.groupBy("filename").agg(F.sum("pixels").alias("n"))
    assert sums.filter(F.col("n") != 64).count() == 0
    shares = C.top_colors_share(profile, 100).groupBy("annotation").agg(F.sum("share").alias("s"))
    assert shares.filter(F.abs(F.col("s") - 100) > 0.05).count() == 0
    most = C.most_colored(profile, 4).collect()
    assert len(most) == 4 and [r.colored_pixels for r in most] == sorted((r.colored_pixels for r in most), reverse=True)


def test_image_without_pixels_keeps_a_histogram_row(spark):
    joined = spark.createDataFrame([("f", "a", "g", 4, b"")], "filename string, annotation string, `group` string, nChannels int, data binary")
    profile = C.color_profile(joined)
    hist = C.color_histogram(profile).collect()
    assert [(r.color, r.pixels) for r in hist] == [(None, 0)]
    least = C.least_colored_ratio(profile, 5).first()
    assert (least.colored_pixels, least.transparent_pixels, least.colored_ratio) == (0, 0, None)


def test_signature_and_group_questions(spark):
    rows = [
        ("1", "one", "activities", 4, bytes([0, 0, 255, 255] * 3 + [255, 0, 0, 255] * 2 + [0, 0, 0, 255])),
        ("2", "two", "activities", 4, bytes([0, 0, 255, 255] * 1)),
        ("3", "three", "other", 4, bytes([0, 0, 255, 255] * 9)),
    ]
    joined = spark.createDataFrame(rows, "filename string, annotation string, `group` string, nChannels int, data binary")
    profile = C.color_profile(joined)
    sig = C.color_signature_count(profile, ["Red", "Blue", "Black"]).first()
    assert (sig.signature, sig.images) == ("Red-Blue-Black", 1)
    red = C.most_of_color(profile, "Red", "activities", 5).collect()
    assert [(r.annotation, r.red_pixels) for r in red] == [("one", 3), ("two", 1)]
    top = C.top_colors_share(profile, 3, "one").collect()
    assert [(r.rank, r.color, r.share) for r in top] == [(1, "Red", 50.0), (2, "Blue", 33.33), (3, "Black", 16.67)]


def test_dates_are_dates(spark):
    df = spark.createDataFrame([(dt.date(2006, 1, 1),), (dt.date(2015, 12, 31),), (dt.date(2016, 1, 1),)], "release_date date")
    assert S.released_between(df, "2006-01-01", "2015-12-31").count() == 2
