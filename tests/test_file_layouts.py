"""CSV files of several layouts, broken JSON lines, large images in slices."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import colors as C
from touchline.sources import malformed_metadata, read_metadata, read_sales_csv, readers


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.mark.parametrize("one_by_one", [256, 1])
def test_files_of_different_column_orders_are_read_in_one_call(spark, tmp_dir, monkeypatch, one_by_one):
    monkeypatch.setattr(readers, "HEADERS_ONE_BY_ONE", one_by_one)
    _write(tmp_dir, "a 1%.csv", "publisher|release_date|na_sales|total_sales\nA|2001-02-03|1.50|2.00\n")
    _write(tmp_dir, "b.csv", "total_sales|title|na_sales|publisher|release_date\n4.00|x|3.00|B|2002-01-01\n5.00|y||B|2002-01-02\n")
    _write(tmp_dir, "c.csv", "publisher|release_date|na_sales|total_sales\nC|2003-01-01|0.10|0.20\n")
    _write(tmp_dir, "empty.csv", "")
    got = sorted((r.publisher, str(r.release_date), str(r.na_sales), str(r.total_sales)) for r in read_sales_csv(spark, tmp_dir).collect())
    assert got == [("A", "2001-02-03", "1.50", "2.00"), ("B", "2002-01-01", "3.00", "4.00"), ("B", "2002-01-02", "None", "5.00"), ("C", "2003-01-01", "0.10", "0.20")]


def test_a_file_without_a_column_is_named(spark, tmp_dir):
    _write(tmp_dir, "good.csv", "publisher|release_date|na_sales|total_sales\nA|2001-02-03|1.50|2.00\n")
    _write(tmp_dir, "short.csv", "publisher|release_date|na_sales\nA|2001-02-03|1.50\n")
    with pytest.raises(ValueError, match="short.csv has no column total_sales"):
        read_sales_csv(spark, tmp_dir)


def test_broken_lines_are_returned_not_turned_into_null_rows(spark, tmp_dir):
    good = '{"hexcode":"1F600","annotation":"grinning","group":"smileys","more":{"x":1}}'
    broken = ['{"hexcode":"1F601","annotation":"gri', '{"hexcode":"1F602","group":[}', "not json"]
    _write(tmp_dir, "m.jsonl", "\n".join([good, broken[0], "", '{"hexcode":"1F603"}', *broken[1:], "  "]) + "\n")
    assert sorted((r.hexcode, r.group) for r in read_metadata(spark, tmp_dir).collect()) == [("1F600", "smileys"), ("1F603", None)]
    assert read_metadata(spark, tmp_dir).select("hexcode").count() == 2
    bad = malformed_metadata(spark, tmp_dir)
    assert sorted(r.line for r in bad.collect()) == sorted(broken)
    assert {r.file for r in bad.collect()} == {"m.jsonl"} and bad.count() == 3


def test_one_large_image_is_counted_by_several_tasks(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    n = 4000
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 256, (40, 4), np.uint8)
    pixels = kinds[rng.integers(0, 40, n * n)].tobytes()
    rows = {"filename": ["big", "small", "partial", "none", "odd"], "nChannels": [4, 4, 4, 4, 0], "data": [pixels, pixels[:36], pixels[:11], None, b"abc"]}
    table = pa.table(rows, schema=pa.schema([("filename", pa.string()), ("nChannels", pa.int32()), ("data", pa.binary())]))
    pq.write_table(table, os.path.join(tmp_dir, "images.parquet"), use_dictionary=False)
    files = spark.read.parquet(os.path.join(tmp_dir, "images.parquet"))
    slices = C.image_slices(files.where("filename = 'big'"), ["filename"], 1 << 20)
    # every slice is whole pixels, and they are dealt to many tasks
    dealt = slices.select(F.length("data").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert sum(r.n for r in dealt) == 4 * n * n and all(r.n % 4 == 0 for r in dealt) and len({r.p for r in dealt}) > 4
    split = {r.filename: r for r in C.color_counts(files, split_bytes=1 << 20).collect()}
    small = {r.filename: r for r in C.color_counts(files.where("filename <> 'big'")).collect()}
    assert {k: v for k, v in split.items() if k != "big"} == small
    # each kind of pixel is named once and counted in numpy
    named = spark.createDataFrame([(i, bytearray(k.tobytes())) for i, k in enumerate(kinds)], "i int, px binary").select("i", C.pixel_color(F.hex("px")).alias("color")).collect()
    codes, counts = np.unique(np.frombuffer(pixels, "<u4"), return_counts=True)
    of = {int(np.frombuffer(kinds[r.i].tobytes(), "<u4")[0]): r.color for r in named}
    want: dict[str, int] = {}
    for code, k in zip(codes.tolist(), counts.tolist(), strict=True):
        want[of[code]] = want.get(of[code], 0) + k
    assert split["big"].total_pixels == n * n and {c.color: c.pixels for c in split["big"].counts} == want
