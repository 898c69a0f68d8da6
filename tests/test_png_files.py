"""The PNG sink and the image source that reads its files back."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from data_folders import SF_SMALL
from touchline.operators import colors as C
from touchline.sources import fixtures as fx
from touchline.sources import read_images
from touchline.sources.png import PngWriter, tidy, write_pngs

SCHEMA = "name string, height int, width int, nChannels int, data binary"


def picture(h, w, c, seed=0):
    return bytearray(np.random.default_rng(seed).integers(0, 256, h * w * c, np.uint8).tobytes())


def test_pictures_come_back_byte_for_byte(spark, tmp_dir):
    sizes = [(1, 1, 3), (1, 1, 4), (3, 7, 3), (40, 33, 4), (1200, 700, 4), (700, 1200, 3), (1, 2000, 4), (2000, 1, 3)]
    rows = [(f"p{i} 100%/é", h, w, c, picture(h, w, c, i)) for i, (h, w, c) in enumerate(sizes)]
    path = os.path.join(tmp_dir, "out")
    write_pngs(spark.createDataFrame(rows, SCHEMA).repartition(5), path)
    got = {name: tuple(rest) for name, *rest in read_images(spark, path).select(C.stem(F.col("image.origin")), "image.height", "image.width", "image.nChannels", "image.mode", "image.data").collect()}
    assert len(got) == len(rows)
    for name, h, w, c, data in rows:
        assert got[name.replace("/", "%2F")] == (h, w, c, 16 if c == 3 else 24, data)


def test_rows_that_are_no_pictures_keep_their_row(spark, tmp_dir):
    rows = [("bytes", 2, 2, 4, bytearray(b"not a picture")), ("none", None, None, None, None), ("flat", 0, 5, 4, bytearray()), ("two", 1, 1, 2, bytearray(b"ab")), ("ok", 1, 1, 4, bytearray(b"abcd"))]
    path = os.path.join(tmp_dir, "out")
    write_pngs(spark.createDataFrame(rows, SCHEMA), path)
    got = {r.n: (r.height, r.mode, len(r.data)) for r in read_images(spark, path).select(C.stem(F.col("image.origin")).alias("n"), "image.height", "image.mode", "image.data").collect()}
    assert got == {"bytes": (-1, -1, 0), "none": (-1, -1, 0), "flat": (-1, -1, 0), "two": (-1, -1, 0), "ok": (1, 24, 4)}


def test_only_committed_attempts_are_seen(spark, tmp_dir):
    import pyarrow as pa

    path = os.path.join(tmp_dir, "out")
    writer = PngWriter(path)
    batch = pa.RecordBatch.from_pylist([{"name": "a", "height": 1, "width": 1, "nChannels": 4, "data": b"abcd"}])
    lost, kept, failed = (writer.write(iter([batch])) for _ in range(3))
    assert writer.write(iter([])).files == 0
    writer.commit([kept, None, writer.write(iter([]))])
    writer.abort([failed])
    assert lost.files == 1
    assert read_images(spark, path).count() == 1
    assert tidy(spark, path) == 1 and sorted(x[:5] for x in os.listdir(path)) == ["part-"]


def test_sink_states_what_it_needs(spark, tmp_dir):
    with pytest.raises(Exception, match="no column"):
        write_pngs(spark.createDataFrame([("a",)], "name string"), os.path.join(tmp_dir, "x"))


def test_fixture_pictures_have_many_sizes(spark):
    got = fx.pictures(spark, SF_SMALL).select("name", "height", "width", "nChannels", F.length("data").alias("n")).collect()
    assert {(r.height, r.width) for r in got} >= {(1, 1), (1500, 1100)}
    assert {r.nChannels for r in got} == {3, 4}
    assert sum(r.n != r.height * r.width * r.nChannels for r in got) >= len(got) // 20 - 1
